"""Mixing sources to target weights (operator 3).

Capped water-filling gives each source a target: sources above ``max_epochs``
times their size are clamped and their excess goes to the others by weight.
A source's documents are then taken a whole number of times, and a seeded
part of them once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.shared import fresh, pick, saved, table, words

MAX_EPOCHS = 3
SEED = 20_240_517
# Bits of the sampling hash that one counting pass resolves.
STEP_BITS = 12
# Sources are planned on the driver, one row each.
MAX_SOURCES = 1_000_000


def water_fill(sizes: dict, weights: dict, total: float, max_epochs: float = MAX_EPOCHS) -> dict:
    """Targets by weight, none above ``max_epochs`` times its size.

    Sources of size 0 get 0.  If all are clamped the total is not reached.
    """
    cap = {s: max_epochs * n for s, n in sizes.items()}
    target = {s: 0.0 for s in sizes}
    active = [s for s in sizes if sizes[s] > 0 and weights[s] > 0]
    left = float(total)
    while active:
        share = left / sum(weights[s] for s in active)
        over = [s for s in active if share * weights[s] > cap[s]]
        if not over:
            target.update({s: share * weights[s] for s in active})
            break
        for s in over:
            target[s] = float(cap[s])
        left -= sum(cap[s] for s in over)
        active = [s for s in active if s not in set(over)]
    return target


def cyclic_weights(sources: list, cycle: tuple[int, ...] = (1, 2, 3)) -> dict:
    """Weights 1, 2, 3, 1, ... over the sources by code point, NULL last."""
    order = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def _source_key(source: Column) -> Column:
    """Join key in which NULL is a source of its own."""
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


def _plan_frame(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    # One row per source, at most MAX_SOURCES: small enough to broadcast.
    return F.broadcast(spark.createDataFrame(rows, columns))


def _cut_points(rows: DataFrame, wanted: dict) -> dict:
    """For each source the largest hash prefix so that what lies at or below
    it holds the wanted words, as (bits, prefix) refined pass by pass.

    Every pass counts, per source, the sizes in the 4096 cells below the
    prefix found so far, and goes down into the cell where the sum crosses
    the wanted number.  Cells are summed up in Spark, at most 4096 rows of
    each source; only the crossing cell, one row per source, reaches the
    driver.  60 bits tell all but equal rows apart.
    """
    spark = rows.sparkSession
    # Prefix, words missing, words in the cell of that prefix; or the cut.
    state = {s: (0, float(w), 0, None) for s, w in wanted.items() if w > 0}
    upto = Window.partitionBy("none", "name").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(1, 60 // STEP_BITS + 1):
        bits = level * STEP_BITS
        live = [(*_as_key(s), prefix, missing) for s, (prefix, missing, _, done) in state.items() if done is None]
        if not live:
            break
        plan = _plan_frame(spark, live, "none boolean, name string, prefix bigint, missing double")
        cell = F.shiftright("h", 60 - bits)
        cells = (rows.join(plan, (F.col("key.none") == plan.none) & (F.col("key.name") == plan.name))
                 .filter(F.shiftright(cell, STEP_BITS) == F.col("prefix"))
                 .groupBy("none", "name", "missing", cell.alias("cell")).agg(F.sum("size").alias("n"))
                 .filter("n > 0"))
        crossing = {None if r["none"] else r["name"]: r for r in
                    cells.withColumn("upto", F.sum("n").over(upto))
                    .filter("upto > missing and upto - n <= missing").collect()}
        for s, (prefix, missing, _, done) in list(state.items()):
            if done is not None:
                continue
            r = crossing.get(s)
            if r is None:  # everything below the prefix is wanted
                state[s] = (0, 0.0, 0, ((prefix + 1) << (60 - bits + STEP_BITS)) - 1)
            else:
                state[s] = (r["cell"], missing - (r["upto"] - r["n"]), r["n"], None)
    out = {}
    for s, (prefix, missing, size, done) in state.items():
        if done is not None:
            out[s] = done
        else:  # the row (or equal rows) at the cut: in if that comes nearer
            out[s] = prefix if missing * 2 >= size else prefix - 1
    return out


def _as_key(source) -> tuple:
    return source is None, source or ""


def mix_sources(docs: DataFrame, weights, size: Column, source: str = "source",
                keys: tuple[str, ...] = ("doc_id", "text"), total_share: float = 1.0,
                max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Add ``size, source_size, target, times`` to every row of ``docs``.

    ``weights``: function from the list of sources to a weight of each.
    ``times`` is how often the mix takes the row: the whole part of
    target / source size, and once more for rows whose seeded hash of ``keys``
    lies below the source's cut.  The cut is found on exact counts, so a
    source's words differ from its target by half a document at most (more
    only if equal rows, which share a hash, meet the cut).  Reruns agree.
    NULL source is a source of its own, NULL keys hash like any value, rows
    of size 0 follow their hash and add nothing.  ``docs`` is read twice.
    Clashing names in ``docs`` (``size`` ...) are replaced.
    """
    spark = docs.sparkSession
    h, s = fresh(docs, "h", "sz")
    hashed = F.pmod(F.xxhash64(F.lit(seed), *(F.col(f"`{k}`") for k in keys)), F.lit(1 << 60))
    full = docs.withColumns({h: hashed, s: size.cast("bigint")})
    key = _source_key(F.col(f"`{source}`"))
    light = saved(full.select(key.alias("key"), F.col(h).alias("h"), F.col(s).alias("size")), "mix-sizes")
    got = light.groupBy("key").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(got) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {None if r.key.none else r.key.name: r.n or 0 for r in got}
    target = water_fill(sizes, weights(list(sizes)), total_share * sum(sizes.values()), max_epochs)
    whole = {x: min(int(target[x] // sizes[x]), max_epochs) if sizes[x] else 0 for x in sizes}
    cuts = _cut_points(light, {x: target[x] - whole[x] * sizes[x] for x in sizes})
    rows = [(*_as_key(x), sizes[x], float(target[x]), whole[x], cuts.get(x, -1)) for x in sizes]
    names = fresh(full, "p_none", "p_name", "p_size", "p_target", "p_whole", "p_cut", "p_key")
    plan = _plan_frame(spark, rows, ", ".join(f"{n} {t}" for n, t in zip(
        names, ("boolean", "string", "bigint", "double", "int", "bigint"))))
    none, name, p_size, p_target, p_whole, p_cut = (F.col(n) for n in names[:6])
    k = F.col(names[6])
    joined = full.withColumn(names[6], key).join(
        plan, (k["none"] == none) & (k["name"] == name), "left")
    times = p_whole + (F.col(h) <= p_cut).cast("int")
    new = {"size": F.col(s), "source_size": p_size, "target": p_target, "times": times}
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    return joined.select(*keep, *(c.alias(n) for n, c in new.items()))


def mixed(docs: DataFrame, weights, size: Column, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken.

    Same columns as ``docs``; ``options`` as in ``mix_sources``.
    """
    got = mix_sources(docs.withColumn(fresh(docs, "row")[0], F.struct(*(F.col(f"`{c}`") for c in docs.columns))),
                      weights, size, **options)
    row = fresh(docs, "row")[0]
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times")))
    return got.select(row, copies.alias("copy")).select(f"{row}.*")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 1, 2, 3 over the sources."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", source="source", text="text")
    got = mix_sources(docs, cyclic_weights, F.size(words(F.col("text"))))
    return got.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("times")).alias("taken"))
