"""Merkle manifest of a dataset: leaf digests, a tree per run of rows, a tree over the runs, and a proof per row.

Every row is a leaf.  Leaves of one run (say, of one language) stand in a stated order and are numbered without a window
over the run: rows are dealt by ranges of (run, order), numbered inside partitions, and moved on by the counts before.
A level of all trees is one table (run, idx, n, digest).  Each node finds its siblings by equijoins of the table with
itself on computed indices (``idx xor 1`` in binary trees, an offset of the slot otherwise), and the rows of slot zero
emit the parents.  Trees of all runs rise together; a run whose level has one node is done, that node is its subroot.
Subroots, in order of the runs, are the leaves of the last tree.  Proofs come down the same levels: a node's proof is its
own siblings followed by its parent's proof, so that each level is joined once and the upper levels are tiny.

H is the lower-case hex SHA-256 of its concatenated inputs, digests as hex text; between steps digests are binary.

Defined results: null cells are ``-`` in a leaf; null runs come first, then bytewise; null order values come first; equal
order values are ordered by leaf, and equal leaves are equal in all they show; repeated rows are leaves each; a run of one
row has its leaf as subroot, one run's subroot is the root; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.exprs import quoted
from riskloom.session import stage

SIDES = "struct<left:binary,right:binary>"


def cell(value: Column) -> Column:
    """A value inside a leaf: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(data: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def shown(value: Column) -> Column:
    """Bytes as lower-case hex text."""
    return F.lower(F.hex(value))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[cell(v) for v in values]))


def _numbered(rows: DataFrame, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """(run, idx, n, payload): place of each row in its run from 0, and the rows of the run.

    No task holds a run: ranges split runs anywhere, and what is gathered per run is one count a partition.
    """
    keys = ["run", *order]
    placed = stage(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33)),
        "numbered",
    )
    parts = placed.groupBy("run", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("from"))
    by_run = Window.partitionBy("run")
    parts = parts.select(
        "run",
        "part",
        (
            F.coalesce(F.sum("rows").over(by_run.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            - F.col("from")
        ).alias("shift"),
        F.sum("rows").over(by_run).alias("n"),
    )
    return placed.join(parts, ["run", "part"]).select("run", (F.col("place") + F.col("shift")).alias("idx"), "n", *payload)


def _with_siblings(level: DataFrame, arity: int, payload: Sequence[str]) -> DataFrame:
    """Each node with the digests before and behind it among its siblings, by one equijoin for each other slot."""
    lean = level.select("run", F.col("idx").alias("sib"), F.col("digest").alias("other"))
    slot, none, found = F.pmod("idx", F.lit(arity)), F.lit(bytearray()), level
    others = []
    for step in range(1, arity):
        to = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + F.pmod(slot + step, F.lit(arity))
        others.append(f"other{step}")
        found = found.withColumn("sib", to).join(lean.withColumnRenamed("other", others[-1]), ["run", "sib"], "left").drop("sib")

    def side(before: bool) -> Column:
        # the node of slot s was found by step (s - slot) mod arity
        return F.concat(
            none,
            *[
                F.when((slot + step >= arity) == F.lit(before), F.coalesce(other, none)).otherwise(none)
                for step, other in enumerate(others, 1)
            ],
        )

    sides = F.struct(side(True).alias("left"), side(False).alias("right"))
    return found.select("run", "idx", "n", "digest", *payload, sides.alias("sides"))


def folded(node: Column, sides: Column) -> Column:
    """The parent's digest: H of the siblings before, the node and those behind."""
    return F.unhex(F.sha2(F.concat(shown(sides["left"]), shown(node), shown(sides["right"])).cast("binary"), 256))


def _levels(leaves: DataFrame, arity: int, payload: Sequence[str]) -> list[DataFrame]:
    """All levels with siblings, leaves first, each written once; the last ones hold only runs of many rows."""
    out, level = [], leaves
    while True:
        out.append(stage(_with_siblings(level, arity, payload if not out else ()), "level"))
        most = out[-1].agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return out
        level = (
            out[-1]
            .where((F.pmod("idx", F.lit(arity)) == 0) & (F.col("n") > 1))
            .select(
                "run",
                F.expr(f"idx div {arity}").alias("idx"),
                F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
                folded(F.col("digest"), F.col("sides")).alias("digest"),
            )
        )


def _proofs(levels: Sequence[DataFrame], tops: DataFrame | None, arity: int, payload: Sequence[str]) -> DataFrame:
    """(digest, payload, proof, subroot): siblings of each leaf up to its subroot, then the run's own proof in ``tops``.

    ``tops`` has one row per run; it is joined where a run has one node, never to the rows of a run.
    """
    above = None
    for depth, level in reversed(list(enumerate(levels))):
        keep = [F.col(c) for c in ("run", "idx", "digest", *(payload if depth == 0 else ()))]
        here = level.where("n = 1")
        if tops is None:
            here = here.select(*keep, F.array().cast(f"array<{SIDES}>").alias("proof"), F.col("digest").alias("subroot"))
        else:
            here = here.join(tops, "run").select(*keep, "proof", "subroot")
        if above is not None:
            up = above.select("run", F.col("idx").alias("up"), F.col("proof").alias("rest"), "subroot")
            below = level.where("n > 1").withColumn("up", F.expr(f"idx div {arity}")).join(up, ["run", "up"])
            here = here.unionByName(below.select(*keep, F.concat(F.array("sides"), F.col("rest")).alias("proof"), "subroot"))
        # a level is read by one join only; in deep trees the lineage is cut now and then
        above = stage(here, "proofs") if depth and depth % 8 == 0 else here
    return above


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    run_col: str,
    order_col: str,
    arity: int = 2,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the order column, ``leaf``, ``proof`` (siblings before and behind, from the leaf to
    the root), ``subroot`` and ``root`` as bytes, and the columns of ``extra``, expressions over ``docs``.
    """
    if arity < 2:
        raise ValueError("a node has two children at least")
    extra = extra or {}
    payload = ["key", *[f"extra{i}" for i in range(len(extra))]]
    run = quoted(run_col).cast("string")
    leaves = docs.select(  # the only pass over whole texts
        F.when(run.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), run)).alias("run"),
        leaf([quoted(f) for f in fields]).alias("digest"),
        *[c.alias(n) for n, c in zip(payload, [quoted(order_col), *extra.values()])],
    )
    rows = _numbered(stage(leaves, "leaves"), ["key", "digest"], ["digest", *payload])
    levels = _levels(rows, arity, payload)
    ends = [x.where("n = 1").select(F.lit("").alias("run"), F.col("run").alias("key"), "digest") for x in levels]
    runs = stage(reduce(DataFrame.unionByName, ends), "subroots")
    upper = _levels(_numbered(runs, ["key"], ["digest", "key"]), arity, ["key"])
    root = upper[-1].select("digest").first()
    tops = stage(_proofs(upper, None, arity, ["key"]).select(F.col("key").alias("run"), "proof", F.col("digest").alias("subroot")), "tops")
    return _proofs(levels, tops, arity, payload).select(
        F.col("key").alias(order_col),
        F.col("digest").alias("leaf"),
        "proof",
        "subroot",
        F.lit(bytearray(root[0]) if root else bytearray()).alias("root"),
        *[F.col(n).alias(name) for n, name in zip(payload[1:], extra)],
    )


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, node, folded)


def proof_text(proof: Column) -> Column:
    """All siblings of a proof as hex text, left to right, from the leaf to the root."""
    return F.array_join(F.transform(proof, lambda s: F.concat(shown(s["left"]), shown(s["right"]))), "")
