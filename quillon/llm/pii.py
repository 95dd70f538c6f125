"""Personal data by weak supervision, in built-in expressions only.

Candidates of four kinds come from patterns. Three labelers (shape, gazetteer, context) vote on each; expectation
maximisation over the counted vote patterns estimates how reliable each labeler is for each kind; the posteriors
train a logistic span classifier, which is applied as an expression. Candidates that pass the base checks are kept
whatever the classifier says; it adds others."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import shielded, stored, table, unshielded

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive repeats and the look-behinds change no match; they keep matching linear and flat.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser shapes, which only the classifier can accept: written with words or signs around the marks, with other marks
# between digits, IPv6, numbers without a plus.
_MARK = r"(?:\x20?[\[({]\x20?(?:\.|(?i:dot))\x20?[\])}]\x20?|\x20(?i:dot)\x20)"
_AT = r"(?:\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20|\x20@\x20?|@\x20|\x20?＠\x20?)"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:(?:\.|{_MARK})[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}+(?:(?:\.|{_MARK}|\x20\.\x20)[0-9]{{1,3}}+){{3}}(?![0-9]|\.[0-9])"
    r"|(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.-])[0-9]{4}(?:[\x20]{0,2}[\x20./ –-][\x20]{0,2}[0-9]{2,7}){2,4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])|(?:00[1-9][0-9]{0,2}|\(0[0-9]{1,4}\)|0[0-9]{1,4})[\x20./-]{1,2}[0-9]{2,5}(?:[\x20./-][0-9]{2,5}){1,4}(?![0-9A-Za-z]))",
}
# Gazetteers of top-level domains, issuers' card numbers, country calling codes and special addresses.
TLDS = (
    "com|org|net|edu|gov|mil|int|info|biz|name|pro|mobi|jobs|travel|museum|coop|aero|asia|cat|post|tel|xxx|app|dev|page|blog|shop|store|online|site|tech|cloud|email|live|news|media|agency|studio|design|digital|"
    "academy|school|company|group|works|world|life|today|space|website|berlin|london|paris|wien|hamburg|eus|gal|bzh|"
    "ac|ad|ae|af|al|am|ar|at|au|az|ba|bd|be|bg|bh|bo|br|by|ca|ch|ci|cl|cm|cn|co|cr|cu|cy|cz|de|dk|do|dz|ec|ee|eg|es|et|eu|fi|fr|gb|ge|gh|gr|gt|hk|hn|hr|hu|id|ie|il|in|io|iq|ir|is|it|jo|jp|ke|kr|kw|kz|lb|"
    "li|lk|lt|lu|lv|ly|ma|md|me|mk|mt|mx|my|ng|ni|nl|no|np|nz|om|pa|pe|ph|pk|pl|pt|py|qa|ro|rs|ru|sa|se|sg|si|sk|sn|sy|th|tn|tr|tv|tw|tz|ua|ug|uk|us|uy|uz|ve|vn|ye|za"
)
CARDS = (
    r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|"
    r"6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12}|35(?:2[89]|[3-8][0-9])[0-9]{12}|62[0-9]{14,17}|(?:50|5[6-9]|6[0-9])[0-9]{10,17})$"
)
CALLING = r"^\+?(1|7|20|27|3[0-469]|35[0-9]|37[0-9]|38[0-79]|4[0134-9]|42[013]|5[1-8]|50[0-9]|59[0-9]|6[0-6]|67[0-9]|68[0-9]|8[1246]|85[0-9]|88[06]|9[0-58]|96[0-8]|97[0-9]|99[2-8]|2[1-6][0-9]|29[0-9])"
SPECIAL_V4 = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|192\.0\.[02]|198\.(?:1[89]|51\.100)|203\.0\.113|22[4-9]|2[3-5][0-9])\."
SPECIAL_V6 = r"^(?:0*:|[fF][cCdDeEfF]|2001:0?[dD][bB]8:)"
CUES = {
    "email": r"(?i)(mail|contact|write|reach|address|reply)",
    "ip": r"(?i)(\bip\b|ipv[46]|address|host|server|client|from|login|connect|traffic)",
    "card": r"(?i)(card|visa|master|amex|credit|debit|payment|account|paid|charge)",
    "phone": r"(?i)(phone|call|tel|mobile|fax|dial|cell|contact|number|reach|ring)",
}
CUES_AFTER = {
    "email": r"(?i)^[^A-Za-z0-9]{0,4}(e-?mail|is my|to reach|for details)",
    "ip": r"(?i)^[^A-Za-z0-9]{0,4}(port|ip\b|logged|connected|refused|timed)",
    "card": r"(?i)^[^A-Za-z0-9]{0,4}(exp|cvv|cvc|valid|card|visa|amex)",
    "phone": r"(?i)^[^A-Za-z0-9]{0,4}(phone|mobile|cell|fax|tel|ext|direct|office|after)",
}
COUNTER = r"(?i)(version|isbn|issn|serial|invoice|order|ticket|build|rev|section|chapter|part|sku|batch|article|dated?|mac|hash)[^A-Za-z]*$|[$€£]\x20?$"
COUNTER_AFTER = r"(?i)^\x20?(%|€|\$|usd|eur|kg|km|pages|items|rows|o'clock)"
DATE = r"^\(?(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2})"
CONTEXT, CONTEXT_AFTER = 40, 24
ACCEPT, RIDGE = 0.9, 1e-6
BITS = ("long", "separated", "glued_before", "glued_after", "line_start", "loose")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(lengths: Column, block: int = 256) -> Column:
    """Sums of what stands before each element; by blocks, so that arrays of any length stay far from quadratic."""
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / block).cast("int")), lambda b: total(F.slice(lengths, b * block + 1, F.lit(block))))
    upto = let(blocks, lambda bs: F.transform(bs, lambda _, i: total(F.slice(bs, F.lit(1), i))))
    at = lambda i: F.floor(i / block).cast("int")
    return let(upto, lambda u: F.transform(lengths, lambda _, i: F.get(u, at(i)) + total(F.slice(lengths, at(i) * block + 1, i - at(i) * block))))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Of a string of 13 to 19 digits."""
    back = F.split(F.reverse(d), "")
    value = F.transform(F.filter(back, lambda x: x != ""), lambda x, i: let(x.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """The base check."""
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
    if kind == "ip":
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        d = digits(m)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    return F.lit(True)


def octets(m: Column) -> Column:
    """A dotted address whatever its marks."""
    return F.regexp_replace(m, r"[^0-9]+", ".")


def votes(kind: str, m: Column, before: Column, after: Column) -> list[Column]:
    """Shape, gazetteer, context: 1 for personal, 0 for no opinion, -1 against."""
    yes = lambda c: F.when(c, 1).otherwise(-1)
    d = digits(m)
    if kind == "email":
        shape = yes(m.rlike(r"^[A-Za-z0-9].*[A-Za-z]{2,}$") & ~m.rlike(r"(?i)[a-z]\x20at\x20[^\x20]+\.[a-z]+$"))
        known = yes(F.lower(m).rlike(rf"[.\])}}\x20](?:{TLDS})$"))
    elif kind == "ip":
        v6, plain = m.contains(":"), octets(m)
        shape = yes((v6 & m.rlike("[0-9]")) | (~v6 & passes(kind, plain) & ~plain.rlike(r"(^|\.)0[0-9]|^(?:0|127|22[4-9]|2[3-5][0-9])\.") & ~after.rlike(r"^\.[0-9]") & ~before.rlike(r"[0-9]\.$")))
        known = F.when(v6, F.when(m.rlike(SPECIAL_V6), -1).when(m.rlike("^[23][0-9A-Fa-f]{3}:"), 1).otherwise(0)).otherwise(yes(~plain.rlike(SPECIAL_V4)))
    elif kind == "card":
        shape = yes(F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False) & ~m.rlike(DATE))
        known = yes(d.rlike(CARDS))
    else:
        abroad, home = m.rlike(r"^(\+|00[1-9])"), m.rlike(r"^\(?0[1-9]")
        shape = yes(F.length(d).between(9, 15) & ~m.rlike(DATE))
        known = F.when(abroad, yes(F.regexp_replace(m, "^00", "").rlike(CALLING))).when(home, F.when(F.length(d).between(9, 12), 0).otherwise(-1)).otherwise(yes(d.rlike(r"^[2-9][0-8][0-9][2-9]")))
    context = F.when(before.rlike(COUNTER) | after.rlike(COUNTER_AFTER), -1).when(before.rlike(CUES[kind]) | after.rlike(CUES_AFTER[kind]), 1).otherwise(0)
    return [shape, known, context]


def bits(m: Column, before: Column, after: Column, loose: bool) -> Column:
    flags = [F.length(m) > 18, m.rlike(r"[\x20().-]"), before.rlike("[A-Za-z0-9]$"), after.rlike("^[A-Za-z0-9]"), before.rlike(r"(^|\n)[\x20\t]*$"), F.lit(loose)]
    return reduce(lambda a, b: a + b, [f.cast("int") * (1 << i) for i, f in enumerate(flags)])


def found(t: Column, kind: str, pattern: str, is_base: bool) -> Column:
    """All matches of one pattern as structs, with code-point offsets: those of the parts between the matches, added up."""
    p = F.lit(pattern)
    matches = F.regexp_extract_all(t, p, F.lit(0))

    def spans(ms: Column, ps: Column) -> Column:
        lengths = F.transform(ms, lambda m, i: (F.length(m) + F.length(F.get(ps, i))).cast("long"))
        starts = let(lengths, lambda a: running(a))

        def span(m: Column, i: Column, at: Column) -> Column:
            start = F.get(at, i) + F.length(F.get(ps, i))
            before, after = F.substring(F.get(ps, i), -CONTEXT, CONTEXT), F.substring(F.get(ps, i + 1), 1, CONTEXT_AFTER)
            v = votes(kind, m, before, after)
            return F.struct(
                start.alias("start"), (start + F.length(m)).alias("end"), (passes(kind, m) if is_base else F.lit(False)).alias("base"),
                *[x.cast("int").alias(f"v{j}") for j, x in enumerate(v)], bits(m, before, after, not is_base).alias("bits"),
            )

        return let(starts, lambda at: F.transform(ms, lambda m, i: span(m, i, at)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,base:boolean,v0:int,v1:int,v2:int,bits:int>>")
    return let(matches, lambda ms: F.when(F.size(ms) > 0, let(F.split(t, pattern, -1), lambda ps: spans(ms, ps))).otherwise(empty))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add c_email, c_ip, c_card and c_phone: arrays of candidates, those of the base pattern before the others.

    A loose candidate that overlaps a passing base span of any kind is no candidate."""
    t = F.coalesce(F.col(text), F.lit(""))
    quick = {"email": t.contains("@"), "phone": t.contains("+")}
    out = docs.withColumns({f"c_{k}": F.when(quick[k], found(t, k, BASE[k], True)).otherwise(F.array()) if k in quick else found(t, k, BASE[k], True) for k in KINDS})
    taken = F.flatten(F.array(*[F.filter(f"c_{k}", lambda s: s["base"]) for k in KINDS]))
    loose = {k: F.filter(found(t, k, LOOSE[k], False), lambda s: ~F.exists("c_taken", lambda b: _meet(s, b))) for k in LOOSE}
    return out.withColumn("c_taken", taken).withColumns({f"c_{k}": F.concat(f"c_{k}", x) for k, x in loose.items()}).drop("c_taken")


def fit(cells: list[tuple], rounds: int = 60) -> dict[str, list[float]]:
    """Weights of the span classifier by kind, from (kind, v0, v1, v2, bits, n) cells: at most 27 * 64 a kind.

    A kind without candidates has no entry."""
    out = {}
    for kind in KINDS:
        own = sorted(c[1:] for c in cells if c[0] == kind)
        if not own:
            continue
        v = np.array([c[:3] for c in own], dtype=int)
        n = np.array([c[4] for c in own], dtype=float)
        p = 1 / (1 + np.exp(-1.5 * v.sum(1) - v[:, 0]))  # the first guess: a vote, shape counting twice
        for _ in range(rounds):  # Dawid and Skene: each labeler has its own chances of each vote for either class
            like = np.zeros((len(own), 2))
            for c, weight in enumerate((n * (1 - p), n * p)):
                like[:, c] = math.log(weight.sum() + 1)
                for j in range(3):
                    table_ = np.array([weight[v[:, j] == x].sum() + 1 for x in (-1, 0, 1)])
                    like[:, c] += np.log(table_ / table_.sum())[v[:, j] + 1]
            p = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -60, 60)))
        x = np.array([features(c[:3], c[3]) for c in own], dtype=float)
        w = np.zeros(x.shape[1])
        scale = n / n.sum()
        for _ in range(50):  # Newton steps of a logistic regression on the posteriors, with a small ridge
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (scale * q * (1 - q))[:, None]).T @ x + RIDGE * np.eye(len(w))
            w = w + np.linalg.solve(hessian, x.T @ (scale * (p - q)) - RIDGE * w)
        out[kind] = [float(a) for a in w]
    return out


def features(v: tuple, b: int) -> list[float]:
    return [1.0, *[float(x == 1) for x in v], *[float(x == -1) for x in v], *[float(b >> i & 1) for i in range(len(BITS))]]


def score(s: Column, weights: list[float]) -> Column:
    v = [s[f"v{j}"] for j in range(3)]
    x = [F.lit(1.0), *[(a == 1).cast("double") for a in v], *[(a == -1).cast("double") for a in v], *[s["bits"].bitwiseAND(1 << i).cast("boolean").cast("double") for i in range(len(BITS))]]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, [c * w for c, w in zip(x, weights, strict=True)])))


def _cell(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["v0"], s["v1"], s["v2"], s["bits"])


def _accepted(weights: list[float] | None) -> Callable[[Column], Column]:
    return lambda s: s["base"] | (score(s, weights) >= ACCEPT) if weights else s["base"]


def _shown(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))


def _meet(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _apart(kind: str) -> Column:
    """The accepted spans of a kind, but for added ones that overlap a base span or an added one of an earlier kind, and
    for loose ones that overlap a match of the kind's base pattern."""
    earlier = [F.col(f"g_{k}") for k in KINDS[: KINDS.index(kind)]] + [F.filter(f"g_{k}", lambda s: s["base"]) for k in KINDS[KINDS.index(kind) + 1 :]]
    taken = F.flatten(F.array(*earlier))
    is_loose = lambda s: s["bits"].bitwiseAND(1 << BITS.index("loose")) > 0
    strict = F.filter(f"g_{kind}", lambda s: ~is_loose(s))
    return F.filter(f"g_{kind}", lambda s: s["base"] | ~(F.exists(taken, lambda b: _meet(s, b)) | (is_loose(s) & F.exists(strict, lambda b: _meet(s, b)))))


def find_pii(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each row of docs: the columns of keep (default: all but the text), and for each kind p_<kind>, an
    array of spans (start, end, base) in order of start: code points, end exclusive.

    Null text is empty and has no spans; texts of any length are read whole; repeated rows each have theirs; of added
    spans that overlap the one of the earlier kind stays; with no candidates at all no classifier is fitted; an empty
    table gives an empty one. Other columns may have any names; those named like an added one are replaced. The
    candidates are stored once in the shared folder and read for fitting and for the result."""
    docs, hidden = shielded(docs if keep is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]), text)
    names = [*hidden] + ([text] if text in (keep or ()) else [])
    cs = stored(candidates(docs, text).select(*names, *[f"c_{k}" for k in KINDS]), "pii")
    every = F.flatten(F.array(*[F.transform(f"c_{k}", _cell(k)) for k in KINDS]))
    counted = cs.select(F.explode(every).alias("s")).groupBy("s").count()
    weights = fit([(*r["s"], r["count"]) for r in counted.collect()])  # at most 4 * 27 * 64 rows, whatever the input
    good = cs.withColumns({f"g_{k}": F.filter(f"c_{k}", _accepted(weights.get(k))) for k in KINDS})
    out = [F.sort_array(F.transform(_apart(k), lambda s: F.struct(s["start"], s["end"], s["base"]))).alias(f"p_{k}") for k in KINDS]
    return unshielded(good.select(*names, *out), hidden)


def joined(base_only: bool) -> Column:
    """kind:start:end of all spans, comma-joined."""
    parts = []
    for k in KINDS:
        c = F.filter(f"p_{k}", lambda s: s["base"]) if base_only else F.col(f"p_{k}")
        parts.append(F.transform(c, _shown(k)))
    return F.array_join(F.concat(*parts), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: spans of personal data in every document."""
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = {f"n_{k}": F.size(F.filter(f"p_{k}", lambda s: s["base"])).cast("long") for k in KINDS}
    return out.select("doc_id", *[c.alias(k) for k, c in n.items()], F.sha2(joined(True), 256).alias("base_sha256"), joined(False).alias("spans"))
