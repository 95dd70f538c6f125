"""Logistic regressions with group effects, any number of them at once, as rounds of grouped sums.

A model has one or two slopes and an intercept for each of its groups. A round of Newton's method needs, of each group,
fifteen sums over its cells: of weights, residuals and squared residuals with the columns' products. The intercepts are swept
out of these sums, so that what is left to solve has the size of the slopes and is written as an expression. All models that
are still moving take a round together, in one pass over their cells; no model's cells meet anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.shared import Scratch

ROUNDS, SETTLED, FAR = 60, 1e-10, 30.0
#: Of sums that are zero but for rounding.
NOTHING = 1e-10
DEPENDENT, SEPARATED, UNSETTLED, FEW = "columns depend on each other", "events are separated", "no convergence", "too few clusters"

STATE = ("_g", "_a", "_bx", "_bt")


#: Products of the columns whose sums a round needs; x and t are the slopes' columns.
PRODUCTS = {"1": "1", "x": "_x", "t": "_t", "xx": "_x * _x", "xt": "_x * _t", "tt": "_t * _t"}


def _sums(cells: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each model and group: w.. (weights), r.. (residuals), s.. (squared residuals) times the products."""
    held = [*keys, *STATE, "_x", "_t"]
    rows = cells.join(state, [*keys, "_g"]).selectExpr(*held, "_n", "_e", "_a + _bx * _x + _bt * _t AS eta").selectExpr(*held, "_n", "_e", "abs(eta) AS far", "1 / (1 + exp(-eta)) AS mu")
    rows = rows.selectExpr(*held, "far", "_n * mu * (1 - mu) AS w", "_e - _n * mu AS r").selectExpr("*", "r * r AS s")
    sums = [f"sum({f} * {p}) AS {f}{n}" for f in "wrs" for n, p in PRODUCTS.items() if f != "r" or len(n) == 1]
    state_ = [f"any_value({c}) AS {c}" for c in STATE[1:]]
    return rows.groupBy(*keys, "_g").agg(*map(F.expr, [*state_, *sums, "max(far) AS far"]))


def _stepped(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The state after a step, with the model's step, slope, variance and what is wrong."""
    model = f"OVER (PARTITION BY {', '.join(keys)})"  # a row a group
    over = {
        "hxx": "wxx - wx * mx", "hxt": "wxt - wx * mt", "htt": "wtt - wt * mt", "ux": "rx - mx * r1", "ut": "rt - mt * r1", "axx": "wxx", "att": "wtt",
        "vxx": "sxx - 2 * mx * sx + mx * mx * s1", "vxt": "sxt - mx * st - mt * sx + mx * mt * s1", "vtt": "stt - 2 * mt * st + mt * mt * s1",
    }
    out = sums.selectExpr("*", "wx / w1 AS mx", "wt / w1 AS mt").selectExpr(*keys, *STATE, "r1", "mx", "mt", "w1", *[f"sum({x}) {model} AS {n}" for n, x in over.items()], f"max(far) {model} AS far")
    # flat: a second slope that says nothing is left out; rest: what x says beside it, which is 1 over its place in the inverse; ixt: its neighbour there
    out = out.selectExpr("*", f"htt <= {NOTHING} * att AS flat").selectExpr("*", "if(flat, hxx, hxx - hxt * hxt / htt) AS beside")
    out = out.selectExpr("*", f"hxx <= {NOTHING} * axx OR beside <= {NOTHING} * hxx AS dependent").selectExpr("*", "if(dependent, NULL, beside) AS rest")
    out = out.selectExpr("*", "if(flat, 0, -hxt / (htt * rest)) AS ixt").selectExpr("*", "ux / rest + ixt * ut AS dx").selectExpr("*", "if(flat, 0, (ut - hxt * dx) / htt) AS dt")
    out = out.selectExpr("*", "r1 / w1 - mx * dx - mt * dt AS da").selectExpr("*", f"max(greatest(abs(da), abs(dx), abs(dt))) {model} AS size")
    wrong = f"CASE WHEN dependent THEN '{DEPENDENT}' WHEN far > {FAR} OR size IS NULL OR isnan(size) THEN '{SEPARATED}' END"
    variance = "(vxx / rest + 2 * ixt * vxt) / rest + ixt * ixt * vtt"
    return out.selectExpr(*keys, "_g", "_a + da AS _a", "_bx + dx AS _bx", "_bt + dt AS _bt", "size AS _size", f"{variance} AS _v", f"{wrong} AS _wrong")


def grouped_logit(cells: DataFrame, keys: list[str], group: str, x: str, t: str, n: str, events: str, scratch: Scratch) -> DataFrame:
    """For each model (keys): slope of x, its cluster-robust variance (each cell a cluster), or a note.

    cells: n persons with events of them at x and t; t is zero throughout for models with one slope. Groups whose
    persons all have the event, or none, tell nothing of the slopes (their intercepts have no bound); they count as
    columns, rows and clusters. Models without any other group are separated. Each round is written to scratch, and what
    is returned reads it."""
    own = cells.select(*keys, F.col(group).alias("_g"), F.col(x).cast("double").alias("_x"), F.col(t).cast("double").alias("_t"), F.col(n).cast("double").alias("_n"), F.col(events).cast("double").alias("_e")).filter("_n > 0")
    by = own.groupBy(*keys, "_g").agg(F.sum("_n").alias("_n"), F.sum("_e").alias("_e"), F.count("*").alias("_c"), F.sum("_x").alias("_x"), F.sum("_t").alias("_t"), F.max(F.abs("_t")).alias("_m"))
    groups = scratch.put(by)
    model = groups.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.sum("_c").alias("clusters"), (F.count("*") + 1 + F.when(F.max("_m") > 0, 1).otherwise(0)).alias("columns"), (F.sum("_x") / F.sum("_c")).alias("_cx"), (F.sum("_t") / F.sum("_c")).alias("_ct"))
    models = scratch.put(model)
    state = groups.filter("_e > 0 and _e < _n").select(*keys, "_g", F.log(F.col("_e") / (F.col("_n") - F.col("_e"))).alias("_a"), F.lit(0.0).alias("_bx"), F.lit(0.0).alias("_bt"))
    centred = own.join(models.select(*keys, "_cx", "_ct"), keys).join(state.select(*keys, "_g"), [*keys, "_g"], "left_semi")
    work = scratch.put(centred.select(*keys, "_g", (F.col("_x") - F.col("_cx")).alias("_x"), (F.col("_t") - F.col("_ct")).alias("_t"), "_n", "_e"))
    ended = []
    for k in range(ROUNDS):
        stepped = scratch.put(_stepped(_sums(work, state, keys), keys))
        over = F.col("_wrong").isNotNull() | (F.col("_size") < SETTLED)
        last = k == ROUNDS - 1
        ended.append(stepped if last else stepped.filter(over))
        state = stepped.filter(~over).select(*keys, *STATE)
        if last or state.isEmpty():
            break
    done = ended[0]
    for more in ended[1:]:
        done = done.unionByName(more)
    note = F.coalesce("_wrong", F.when(~(F.col("_size") < SETTLED), UNSETTLED))
    fits = done.groupBy(*keys).agg(F.any_value("_bx").alias("slope"), F.any_value("_v").alias("_v"), F.any_value(note).alias("_note"))
    few = (F.col("clusters") < 2) | (F.col("rows") <= F.col("columns"))
    factor = F.col("clusters") / (F.col("clusters") - 1) * (F.col("rows") - 1) / (F.col("rows") - F.col("columns"))
    out = models.select(*keys, "rows", "clusters", "columns").join(fits, keys, "left")
    # a model that nothing is known of has no group to move
    out = out.withColumn("note", F.coalesce("_note", F.when(F.col("slope").isNull(), SEPARATED), F.when(few, FEW), F.lit("")))
    sound = F.col("note") == ""
    return out.select(*keys, F.when(sound, F.col("slope")).alias("slope"), F.when(sound, F.col("_v") * factor).alias("variance"), "note")
