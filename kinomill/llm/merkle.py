"""Merkle manifest of a dataset: nested-interval labels, proofs by containment joins between level buckets.

Leaves are ranked inside their part (say, a source) by range partitions and per-piece
offsets; every node is labelled with the interval [lo, hi) of leaf ranks it covers, so that a node of
level k starts at a multiple of 3^k and an ancestor is whatever contains the interval. Levels are kept in
buckets of ``LEVELS``: a *cell* is the part of the tree between a node on the border of two buckets and
its at most 3^LEVELS descendants on the border below, one bounded row with the digests of each level.
Ancestors are attached by joining the cells of a bucket with the nodes of the bucket above that contain
them, top down; a leaf meets all its ancestors after one join per bucket, and a row of that join stands for
81 leaves. The siblings of a node are its parent's interval without its own: what lies left of it and what
lies right of it, two slices of the cell's level.

The roots of the parts, ordered, are the leaves of one more tree of the same kind. Nothing but the heights
and the last root comes to the driver. No part is gathered: a third of all leaves in one part are
as many cells as they fill.

Defined results: null fields are ``-``; a null part comes first. Leaves of a part ascend by ``doc_id`` (null first), then
by digest; equal rows are leaves of their own, with proofs of their own. A null id is never tampered with.
An empty table has no leaves, parts or root. Columns other than those hashed are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinomill.llm.common import task_count

FAN = 3
LEVELS = 4
CELL = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*fields: Column) -> Column:
    """Hex SHA-256 of fields, each as its byte count, a colon and its value; ``-`` for null."""
    def stated(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[stated(c) for c in fields]).cast("binary"), 256)


def part_key(source: Column) -> Column:
    """The part as text that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _rank(leaves: DataFrame, order: list[str], path: str) -> DataFrame:
    """``leaves`` with lo, their rank in the part, and n, the part's size; the ranges are written once below ``path``."""
    by = ["part", *order, "digest"]
    numbered = leaves.withColumn("tie", F.monotonically_increasing_id())  # equal rows, too, are cut at range borders
    dealt = numbered.repartitionByRange(task_count(leaves.sparkSession), *by, "tie").sortWithinPartitions(*by, "tie")
    placed = dealt.drop("tie").select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("at"))
    placed.write.parquet(path)
    placed = leaves.sparkSession.read.schema(placed.schema).parquet(path)
    # Fewer rows than parts and pieces together.
    spans = placed.groupBy("part", "piece").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("part")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("part", "piece", "start", before.alias("before"), F.sum("rows").over(whole).alias("n"))
    lo = F.col("at") - F.col("start") + F.col("before")
    return placed.join(spans, ["part", "piece"]).withColumn("lo", lo).drop("piece", "at", "start", "before")


def _next_level(below: Column, width: int) -> Column:
    """Digests one level up; none once the part is one node of ``width`` leaves."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(below) / F.lit(FAN)).cast("int") - 1)
    up = F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * FAN + 1, F.lit(FAN)), "").cast("binary"), 256))
    return F.when(F.col("n") > width, up)


def _cells(nodes: DataFrame, bucket: int, extra: list[str]) -> DataFrame:
    """Cells of a level bucket from its lowest nodes (part, n, lo, digest): the digests d0, d1, .. of each level and their top."""
    unit = FAN ** (LEVELS * bucket)
    held = F.sort_array(F.collect_list(F.struct("lo", "digest", *extra)))
    cells = nodes.groupBy("part", "n", (F.floor(F.col("lo") / (unit * CELL)) * (unit * CELL)).cast("long").alias("cell_lo")).agg(
        held.alias("held")
    )
    cells = cells.withColumn("d0", F.transform("held", lambda x: x["digest"]))
    for level in range(LEVELS):
        cells = cells.withColumn(f"d{level + 1}", _next_level(F.col(f"d{level}"), unit * FAN**level))
    top = F.coalesce(*[F.element_at(f"d{level}", 1) for level in range(LEVELS, -1, -1)])
    return cells.withColumn("top", top)


def _steps(unit: int) -> Column:
    """Siblings left and right of the node ``item`` of a cell and of its ancestors in the cell, one step per level."""
    place = ((F.col("item.lo") - F.col("cell_lo")) / F.lit(unit)).cast("int")
    steps = []
    for level in range(LEVELS):
        digests, at = F.col(f"d{level}"), F.floor(place / F.lit(FAN**level)).cast("int")
        first = at - at % FAN  # the parent's interval begins here; without the node's own there is a left and a right rest
        left = F.array_join(F.slice(digests, first + 1, at - first), "")
        right = F.array_join(F.slice(digests, at + 2, first + FAN - 1 - at), "")
        steps.append(F.when(F.col("n") > unit * FAN**level, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


_NO_STEPS = "cast(array() as array<struct<left: string, right: string>>)"


@dataclass(frozen=True)
class Forest:
    """Trees of parts below a folder, a table of cells per level bucket."""

    spark: SparkSession
    path: str
    buckets: int
    extra: tuple[str, ...]

    @classmethod
    def write(cls, leaves: DataFrame, order: list[str], path: str, extra: tuple[str, ...] = ()) -> Forest:
        """Build from (part, digest), the columns ``order`` and those to keep with the leaves."""
        spark = leaves.sparkSession
        nodes, bucket = _rank(leaves, order, f"{path}/ranked"), 0
        while True:
            where = f"{path}/cells/{bucket}"
            cells = _cells(nodes, bucket, list(extra) if not bucket else [])
            cells.write.parquet(where)
            cells = spark.read.schema(cells.schema).parquet(where)
            width = FAN ** (LEVELS * (bucket + 1))
            nodes = cells.where(F.col("n") > width).select("part", "n", F.col("cell_lo").alias("lo"), F.col("top").alias("digest"))
            bucket += 1
            if nodes.isEmpty():
                return cls(spark, path, bucket, extra)

    def cells(self, bucket: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells/{bucket}")

    def nodes(self) -> DataFrame:
        """(part, level, lo, hi, digest): every node with its label; the leaves are level 0."""
        out = None
        for b in range(self.buckets):
            for level in range(LEVELS + 1):
                width = FAN ** (LEVELS * b + level)
                if level == LEVELS and b + 1 < self.buckets:
                    continue  # the next bucket's lowest level, but for parts that end here
                lo = F.col("cell_lo") + F.col("at") * F.lit(width)
                found = self.cells(b).select("part", "n", "cell_lo", F.posexplode(f"d{level}").alias("at", "digest"))
                found = found.select(
                    "part", F.lit(LEVELS * b + level).alias("level"), lo.alias("lo"), F.least(lo + width, "n").alias("hi"), "digest"
                )
                out = found if out is None else out.unionByName(found)
            if b + 1 < self.buckets:
                width = FAN ** (LEVELS * (b + 1))
                ended = self.cells(b).where((F.col("n") <= width) & F.col(f"d{LEVELS}").isNotNull())
                ended = ended.select("part", F.lit(LEVELS * (b + 1)).alias("level"), F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), F.col("top").alias("digest"))
                out = out.unionByName(ended)
        return out

    def _ending(self, bucket: int) -> DataFrame:
        """Cells that are the top of their part: one per part."""
        return self.cells(bucket).where(F.col("n") <= FAN ** (LEVELS * (bucket + 1)))

    def roots(self) -> DataFrame:
        """(part, n, digest) of each part."""
        out = None
        for b in range(self.buckets):
            found = self._ending(b).select("part", "n", F.col("top").alias("digest"))
            out = found if out is None else out.unionByName(found)
        return out

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """Each leaf (part, n, lo, digest, kept columns) with ``steps``, its siblings level by level up to the part's root.

        ``above`` (part, steps, ..) continues them: the steps of each part's root and further columns to hand down.
        """
        handed = [c for c in above.columns if c not in ("part", "steps")] if above is not None else []
        found = None
        for b in range(self.buckets - 1, -1, -1):
            unit = FAN ** (LEVELS * b)
            ends = self._ending(b).select(F.col("part").alias("a_part"), F.col("cell_lo").alias("a_lo"), F.expr(_NO_STEPS).alias("a_steps"))
            if above is not None:
                more = above.select(F.col("part").alias("m_part"), F.col("steps").alias("m_steps"), *handed)
                ends = ends.join(more, F.col("a_part") == F.col("m_part")).select("a_part", "a_lo", F.col("m_steps").alias("a_steps"), *handed)
            if found is not None:
                lower = found.select(F.col("part").alias("a_part"), F.col("lo").alias("a_lo"), F.col("steps").alias("a_steps"), *handed)
                ends = ends.unionByName(lower)
            # A cell lies inside just one node of the bucket above: the one whose interval starts where the cell does.
            met = self.cells(b).join(ends, (F.col("part") == F.col("a_part")) & (F.col("cell_lo") == F.col("a_lo")))
            kept = self.extra if not b else ()
            each = met.withColumn("item", F.explode("held"))
            found = each.select(
                "part", "n", F.col("item.lo").alias("lo"), F.col("item.digest").alias("digest"), *[F.col(f"item.{c}").alias(c) for c in kept],
                F.concat(_steps(unit), "a_steps").alias("steps"), *handed,
            )
        return found


def proof_digest(steps: Column) -> Column:
    """Hex SHA-256 of all siblings of a proof."""
    texts = F.transform(steps, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(texts, "").cast("binary"), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """Trees of all parts and the tree over their roots."""

    parts: Forest
    top: Forest

    @classmethod
    def write(cls, rows: DataFrame, path: str, order: list[str], extra: tuple[str, ...] = ()) -> Manifest:
        """Manifest of ``rows`` (part, digest, ``order`` and ``extra``) below a new folder."""
        parts = Forest.write(rows, order, f"{path}/parts", extra)
        roots = parts.roots().select(F.lit("").alias("part"), F.col("part").alias("name"), "digest")
        return cls(parts, Forest.write(roots, ["name"], f"{path}/top", ("name",)))

    def root(self) -> DataFrame:
        """(digest): one row, none for an empty dataset."""
        return self.top.roots().select("digest")

    def proofs(self) -> DataFrame:
        """Each leaf with its kept columns, ``subroot``, ``root`` and ``steps`` up to the root."""
        roots = self.top.roots().select("part", F.col("digest").alias("root"), F.expr(_NO_STEPS).alias("steps"))
        above = self.top.paths(roots).select(F.col("name").alias("part"), F.col("digest").alias("subroot"), "root", "steps")
        return self.parts.paths(above)


def verify(docs: DataFrame, path: str, tampered: Column, text: Column) -> DataFrame:
    """Prove every document against the manifest of ``docs``, with ``text`` in place of its own where ``tampered``.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    changed = F.when(tampered & text.isNotNull(), digest_of(*[text if f == "text" else F.col(f) for f in FIELDS]))
    rows = docs.select(
        part_key(F.col("source")).alias("part"), "doc_id", digest_of(*map(F.col, FIELDS)).alias("digest"), changed.alias("changed")
    )
    found = Manifest.write(rows, path, ["doc_id"], ("doc_id", "changed")).proofs()
    folded = fold(F.coalesce("changed", "digest"), F.col("steps"))
    proved = found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
