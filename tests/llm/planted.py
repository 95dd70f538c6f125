"""Texts with personal data that the base patterns miss, and with look-alikes."""

import random

WORDS = "the river was cold and seven old men sat near their boats while rain fell over quiet hills".split()
CUES = {
    "email": ["mail me: ", "write to ", "contact ", "", "my address is "], "ip": ["server ", "from host ", "login from ", "", ""],
    "card": ["card ", "paid with visa ", "credit card no. ", "", ""], "phone": ["call ", "phone: ", "mobile ", "fax ", ""],
}


class Plant:
    """Makes texts from a seed; wanted spans are (kind, start, end)."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def number(self, a: int, b: int) -> int:
        return self.rng.randint(a, b)

    def fill(self) -> str:
        return " ".join(self.rng.choice(WORDS) for _ in range(self.number(3, 9)))

    def address(self) -> tuple[str, str, str]:
        pick = self.rng.choice
        return pick(["anna", "bob.king", "j_doe", "li.wei", "maria99", "sam"]), pick(["example", "mail-box", "corp7", "web"]), pick(["com", "org", "de", "co", "net", "fr"])

    def ip(self) -> list[str]:
        return [str(self.rng.choice([8, 23, 51, 77, 91, 145, 188, 201])), *[str(self.number(1, 254)) for _ in range(3)]]

    def card(self, prefix: str, n: int) -> str:
        d = [int(c) for c in prefix] + [self.number(0, 9) for _ in range(n - 1 - len(prefix))]
        return "".join(map(str, [*d, -sum(x if i % 2 else 2 * x - 9 * (2 * x > 9) for i, x in enumerate(reversed(d))) % 10]))

    def groups(self, sign: str) -> str:
        c = self.card("4", 16)
        return sign.join(c[i : i + 4] for i in (0, 4, 8, 12))

    def nanp(self) -> tuple[str, str, str]:
        return f"{self.number(2, 9)}{self.number(0, 8)}{self.number(0, 9)}", f"{self.number(2, 9)}{self.number(10, 99)}", f"{self.number(1000, 9999)}"

    def good(self, kind: str) -> str:
        n = self.number
        if kind == "email":
            return self.rng.choice(["{} [at] {} [dot] {}", "{}(at){}(dot){}", "{} at {} dot {}", "{} @ {}.{}", "{}@ {}.{}"]).format(*self.address())
        if kind == "ip":
            v6 = [":".join(f"{self.rng.choice([0x2001, 0x2A02, 0x2607]) if i == 0 else n(0x1000, 0xFFFF):x}" for i in range(8)), f"2a0{n(0, 9)}:{n(1000, 9999)}::{n(1, 9999)}"]
            return self.rng.choice([*[sign.join(self.ip()) for sign in ("[.]", " . ", "(.)", " dot ")], *v6])
        if kind == "card":
            amex = self.card("37", 15)
            return self.rng.choice([amex, f"{amex[:4]} {amex[4:10]} {amex[10:]}", self.groups("."), self.groups("  "), self.groups(" - "), self.card("36", 14)])
        home = [f"0049 {n(30, 89)} {n(1000, 9999)} {n(100, 999)}", f"0044 20 {n(1000, 9999)} {n(1000, 9999)}", f"020 {n(1000, 9999)} {n(1000, 9999)}", f"(030) {n(100, 999)} {n(10, 99)} {n(10, 99)}"]
        return self.rng.choice([*[form.format(*self.nanp()) for form in ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}")], *home])

    def bad(self) -> str:
        """What looks like personal data and is none."""
        n = self.number
        return self.rng.choice([
            f"version {n(1, 9)}.{n(0, 9)} . {n(0, 9)}", f"invoice {n(1000, 9999)}.{n(1000, 9999)}.{n(1000, 9999)}.{n(1000, 9999)}", f"order {n(10**13, 10**14)}", f"on 0{n(1, 9)}.0{n(1, 9)}.20{n(10, 24)} 12", "we met at noon.Then it rained",
            "look at this.it is old", f"serial 0{n(10, 99)}-{n(1000, 9999)}-{n(10, 99)}", "scope std::dec and add::bad", f"at 10:30:{n(10, 59)}", f"mac 0a:1b:2c:3d:4e:{n(10, 99)}", "host 127[.]0[.]0[.]1", "isbn 978-3-16-148410-0",
            f"{n(300, 999)}[.]{n(300, 999)}[.]1[.]2", f"build {n(1000, 9999)} {n(100000, 999999)} {n(10000, 99999)}",
        ])

    def texts(self, n: int) -> tuple[list[str], list[set[tuple[str, int, int]]]]:
        """n texts of each kind, n with look-alikes alone, and n with data that the base patterns find."""
        texts, wanted = [], []
        for kind in [*CUES] * n:
            before, x = f"{self.fill()} {self.rng.choice(CUES[kind])}", self.good(kind)
            after = f" {self.bad()} {self.fill()}" if self.rng.random() < 0.6 else ""
            texts.append(before + x + self.rng.choice([", ", " ", "; ", ". "]) + self.fill() + after)
            wanted.append({(kind, len(before), len(before) + len(x))})
        for _ in range(n):
            name, host, tld = self.address()
            texts += [f"{self.fill()} {self.bad()} {self.fill()}", f"{self.fill()} {name}@{host}.{tld} and {'.'.join(self.ip())} or {self.card('4', 16)} tel +1 {'-'.join(self.nanp())} {self.fill()}"]
            wanted += [set(), set()]
        return texts, wanted
