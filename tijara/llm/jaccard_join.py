"""N-gram Jaccard join by grouped prefixes, with the linked documents' components.

Two documents link when their sets of distinct ``k``-word shingles have a Jaccard similarity of at
least ``percent`` / 100. All shingles follow one global order, common ones last (a bounded sketch
counts them over the whole corpus). A linked set of n shingles misses at most n - ceil(t n) of them in its
partner, so with p = n - ceil(t n) + 1 two linked sets share at least e + 1 of their first p + e shingles (e = p // 2,
of the smaller one):

1. Documents with equal sets become one node (map-side combined; copies cost one row per task).
2. Nodes of equal size and prefix become one group, posted once under its first p + e shingles.
3. The postings give exact counts. The rarest of the e + 1 shingles that two linked groups both posted can't be among
   the e most frequent ones of either, so a group leaves those out (e of the smallest partner it may have).
   Shingles that one group alone holds come first in that order, so a group of unrelated text keeps none at all.
4. Lists of (shingle, size class) hold what can link: sizes must be within t, so a group goes to its
   own size class and the next one.
5. Star: every node is verified against its group's first node and against a few leaders, those that most of its
   lists share in each of several orders, then against the other leaders whose component still differs. That is a few
   pairs per node, however large a family of near copies is. Verified links give components.
6. Rest: pairs of groups of a list that are not wholly in one component, and groups that aren't themselves, are
   filtered, made distinct, and only then expanded; of their members all pairs in different components are verified
   after size and parity filters. So no link between components is lost; pairs inside one component could not
   change the result.

Pairs are verified on whole sets. Before that each pair must pass the parity filters, which are exact:
two sets differ in at least as many shingles as their parity bits differ. Nodes carry 1024 bits,
those of more shingles than that also at least a bit per shingle.

No list is collected anywhere, and no cap applies: lists of unrelated groups keep all their pairs.

Defined results: null or empty texts have no shingles, link with nothing and are their own
component. Rows without a doc_id have no component and link with nothing. Rows that repeat a doc_id
belong to one document: what any of their texts links with is in its component; n_shingles is each row's own.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tijara.llm.common import BROADCAST_IDS, among, read_documents, slices, stored, texts_of, utf8
from tijara.llm.components import components, joined
from tijara.llm.shingles import WordHashes, in_order, parity_bits, shingle_levels, shingle_sets

PARITY = 1024
LEADERS = 4  # orders in which a list names a leader


def _first(n: int, percent: int) -> int:
    """How many of n shingles, in any one order, a linked set must share one of."""
    return n - (-(-percent * n // 100)) + 1 if n else 0


def _sets(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n (set size), sig (128-bit hash of the set), prefix_key, prefix (p + e first shingles in order), bits, fine."""
    sc = texts.sparkSession.sparkContext
    levels = sc.broadcast(shingle_levels(texts, k))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in slices(batches):
            sets = shingle_sets(words, utf8(batch), k)
            first = [_first(len(s), percent) for s in sets]
            prefix = [in_order(s, levels.value)[:p + p // 2].view(np.int64) for s, p in zip(sets, first, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(map(len, sets), pa.int64()),
                "sig": pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                "prefix_key": pa.array([xxhash.xxh128_digest(s.tobytes()) for s in prefix], pa.binary()),
                "prefix": pa.array(prefix, pa.list_(pa.int64())),
                "bits": pa.array([parity_bits(s, PARITY) for s in sets], pa.list_(pa.int64())),
                "fine": pa.array([parity_bits(s, 1 << (len(s) - 1).bit_length()) if len(s) > PARITY else None for s in sets],
                                 pa.list_(pa.int64()))})

    made = stored(texts.mapInArrow(run, "doc_id bigint, n bigint, sig binary, prefix_key binary, prefix array<bigint>, "
                                        "bits array<bigint>, fine array<bigint>"), "sets")
    levels.unpersist()
    return made


def _full_sets(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in slices(batches):
            found = shingle_sets(words, utf8(batch), k)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("doc_id"), "sig": pa.array([xxhash.xxh128_digest(s.tobytes()) for s in found], pa.binary()),
                "shingles": pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))})

    return texts.mapInArrow(run, "id bigint, sig binary, shingles array<bigint>")


def _may_differ(differ: Column, nx: Column, ny: Column, percent: int) -> Column:
    """Whether sets of these sizes that differ in ``differ`` shingles or more can still link."""
    return (100 + percent) * (nx + ny - differ) >= 2 * percent * (nx + ny)


def _may_link(nx: Column, ny: Column, bx: Column, by: Column, percent: int) -> Column:
    """Size and parity filters; false only for pairs that can't link."""
    differ = sum((F.bit_count(bx[i].bitwiseXOR(by[i])) for i in range(PARITY // 64)), F.lit(0))
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & _may_differ(differ, nx, ny, percent)


def _fine_differ(x: Column, y: Column) -> Column:
    """Differing cells of two long parities; the longer one is folded to the other's length."""
    width = F.least(F.size(x), F.size(y))

    def fold(a: Column) -> Column:
        halves = F.zip_with(F.slice(a, 1, width), F.slice(a, width + 1, width), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) > width, halves).otherwise(a)

    return F.aggregate(F.zip_with(fold(x), fold(y), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)


class _Verifier:
    """Verifies pairs on whole sets; a document's set is made once, when a pair first needs it."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, k: int, percent: int):
        self.texts, self.nodes, self.k, self.percent = texts, nodes, k, percent
        self.sets: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b) among ``pairs`` (u, v): the filters first, then the whole sets."""
        percent = self.percent
        light = [self.nodes.select(F.col("id").alias(x), F.col("sig").alias(f"sig{x}"), F.col("n").alias(f"n{x}"),
                                   F.col("bits").alias(f"b{x}"), F.col("fine").alias(f"f{x}")) for x in "uv"]
        both = pairs.where("u != v").join(light[0], "u").join(light[1], "v").where(
            _may_link(F.col("nu"), F.col("nv"), F.col("bu"), F.col("bv"), percent))
        fine = F.when(F.col("fu").isNotNull() & F.col("fv").isNotNull(), _fine_differ(F.col("fu"), F.col("fv")))
        likely = stored(both.where(_may_differ(F.coalesce(fine, F.lit(0)), F.col("nu"), F.col("nv"), percent)).select(
            "u", "sigu", "v", "sigv"), "likely")
        wanted = likely.select(F.col("u").alias("doc_id")).union(likely.select("v")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select(F.col("id").alias("doc_id")), "doc_id", "left_anti")
        new = stored(_full_sets(among(self.texts, stored(wanted, "wanted"), "doc_id"), self.k), "whole_sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        whole = [self.sets.select(F.col("id").alias(x), F.col("sig").alias(f"sig{x}"), F.col("shingles").alias(f"s{x}")) for x in "uv"]
        common = likely.join(whole[0], ["u", "sigu"]).join(whole[1], ["v", "sigv"]).select(
            "u", "v", F.size(F.array_intersect("su", "sv")).cast("bigint").alias("common"),
            (F.size("su") + F.size("sv")).cast("bigint").alias("total"))
        return stored(common.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select(
            F.col("u").alias("a"), F.col("v").alias("b")), "verified")


def _placed(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``nodes`` with their component so far."""
    return stored(nodes.join(found, nodes["id"] == found["node"], "left").select(
        "id", "group", "n", "bits", F.coalesce("component", "id").alias("component")), "placed")


def _postings(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(group, n, shingle) of every group's first row. ``heads`` has its doc_id and sig; where few rows are others (copies), those
    are broadcast and the prefixes stay where they are, else rows and heads are joined by a shuffle."""
    others = stored(rows.select("doc_id", "sig").join(heads, ["doc_id", "sig"], "left_anti"), "others")
    if others.limit(BROADCAST_IDS // 4 + 1).count() <= BROADCAST_IDS // 4:
        first = rows.join(F.broadcast(others), ["doc_id", "sig"], "left_anti")
    else:
        first = rows.join(heads, ["doc_id", "sig"], "left_semi")
    return first.select(F.col("doc_id").alias("group"), F.col("n").cast("int").alias("n"), F.explode("prefix").alias("shingle"))


def _lists(postings: DataFrame, percent: int) -> DataFrame:
    """(shingle, class, group, n) of the shingles that groups keep: all shared ones but the most frequent."""
    holders = stored(postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "holders")
    shared = postings.join(holders, "shingle").distinct()
    least = F.ceil(percent * F.col("n") / 100)  # the smallest partner's size
    spare = F.floor((least - F.ceil(percent * least / 100) + 1) / 2)
    of_group = Window.partitionBy("group", "n")
    kept = shared.withColumn("place", F.row_number().over(of_group.orderBy("holders", "shingle"))).withColumn(
        "shared", F.count(F.lit(1)).over(of_group)).where(F.col("place") <= F.col("shared") - spare)
    size_class = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    return stored(kept.select("shingle", "group", "n", F.explode(F.array(size_class, size_class + 1)).alias("class")), "lists")


def _rest(lists: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(u, v): pairs of groups with members that could still link into one component, each pair once."""
    spread = stored(placed.groupBy("group").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.when(F.count(F.lit(1)) == 1, F.max("bits")).alias("bits")), "spread")  # of several members none speaks for all
    within = spread.where("low != high").select(F.col("group").alias("u"), F.col("group").alias("v"))
    whole = stored(lists.join(spread.select("group", "low", "high"), "group"), "whole")
    # the component of a list's first group is its main one: main groups need no comparing with each other
    open_lists = whole.groupBy("shingle", "class").agg(
        F.min("low").alias("least"), F.max("high").alias("most"), F.min(F.struct("group", "low")).alias("first")).where(
        "least != most").select("shingle", "class", F.col("first.low").alias("main"))
    entries = stored(whole.join(open_lists, ["shingle", "class"]).join(spread.select("group", "bits"), "group").withColumn(
        "settled", (F.col("low") == F.col("main")) & (F.col("high") == F.col("main"))), "entries")
    x, y = entries.where("not settled").alias("x"), entries.alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    bits = F.col("x.bits").isNull() | F.col("y.bits").isNull() | _may_link(nx, ny, F.col("x.bits"), F.col("y.bits"), percent)
    one = (F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low"))
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") == F.col("y.class"))
                   & (F.col("y.settled") | (F.col("x.group") < F.col("y.group"))) & ~one
                   & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & bits)
    return pairs.select(F.least("x.group", "y.group").alias("u"), F.greatest("x.group", "y.group").alias("v")).unionByName(within).distinct()


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts = texts_of(docs)
    rows = _sets(texts, k, percent)
    usable = rows.where("n > 0 and doc_id is not null")
    every = stored(usable.groupBy("n", "sig", "prefix_key").agg(F.min("doc_id").alias("id")), "nodes")
    # groups of nodes with equal size and prefix; the smallest id names the group
    groups = stored(every.groupBy("n", "prefix_key").agg(F.min("id").alias("group"), F.count(F.lit(1)).alias("members")), "groups")
    grouped = stored(every.join(groups, ["n", "prefix_key"]).select("id", "sig", "n", "group", "members"), "grouped")
    # what each row's set is, and links between the sets of one doc_id
    member = stored(usable.select("doc_id", "n", "sig").join(every.select("n", "sig", "id"), ["n", "sig"]).select("doc_id", "n", "id"), "rows")
    several = member.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("most")).where("b != most").select("doc_id", "b")
    same_id = stored(member.join(several, "doc_id").where("id != b").select(F.col("id").alias("a"), "b").distinct(), "same_id")
    heads = grouped.where(F.col("id") == F.col("group")).select(F.col("id").alias("doc_id"), "sig")
    lists = _lists(_postings(usable, heads), percent)
    listed = grouped.join(lists.select(F.col("group")).distinct().withColumn("listed", F.lit(True)), "group", "left").where(
        "listed or members > 1").drop("listed", "members")
    light = usable.select(F.col("doc_id").alias("id"), "sig", "bits", "fine").dropDuplicates(["id", "sig"])
    nodes = stored(listed.join(light, ["id", "sig"]), "members")
    verifier = _Verifier(texts, nodes, k, percent)

    # star, first step: each node against its group's first node, and that against its commonest leaders
    orders = range(LEADERS)
    lead = stored(lists.groupBy("shingle", "class").agg(*(
        F.min(F.struct((F.col("group") if r == 0 else F.xxhash64("group", F.lit(r))).alias("order"), "group"))["group"].alias(f"leader{r}")
        for r in orders)), "leaders")
    led = stored(lists.join(lead, ["shingle", "class"]).select(
        "group", F.posexplode(F.array(*(f"leader{r}" for r in orders))).alias("order", "leader")).where("group != leader").groupBy(
        "group", "order", "leader").agg(F.count(F.lit(1)).alias("times")), "led")
    best = led.groupBy("group", "order").agg(F.max(F.struct("times", (-F.col("leader")).alias("leader"))).alias("best")).select(
        F.col("group").alias("u"), (-F.col("best.leader")).alias("v"))
    first = stored(nodes.select(F.col("id").alias("u"), F.col("group").alias("v")).unionByName(best).where("u != v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "first")
    found = components(verifier.links(first).unionByName(same_id))
    # second step: against the other leaders, where the component still differs
    placed = _placed(nodes, found)
    where = placed.select(F.col("id").alias("leader"), F.col("component").alias("lead_component")).distinct()
    pairs = placed.join(led.select("group", "leader").distinct(), "group").join(where, "leader").where("component != lead_component").select(
        F.least("id", "leader").alias("u"), F.greatest("id", "leader").alias("v")).distinct()
    second = stored(pairs.join(first, ["u", "v"], "left_anti"), "second")
    found = joined(found, verifier.links(second))

    # the rest: groups with members that are not yet in one component, expanded
    placed = _placed(nodes, found)
    rest = stored(_rest(lists, placed, percent), "rest")
    x, y = placed.alias("x"), placed.alias("y")
    pairs = rest.join(x, F.col("u") == F.col("x.group")).join(y, F.col("v") == F.col("y.group")).where(
        (F.col("x.component") != F.col("y.component")) & ((F.col("u") != F.col("v")) | (F.col("x.id") < F.col("y.id")))
        & _may_link(F.col("x.n"), F.col("y.n"), F.col("x.bits"), F.col("y.bits"), percent))
    pairs = pairs.select(F.least("x.id", "y.id").alias("u"), F.greatest("x.id", "y.id").alias("v")).distinct()
    found = joined(found, verifier.links(pairs.join(first.unionByName(second), ["u", "v"], "left_anti")))

    # rows -> node of their set -> component
    linked = member.join(found, F.col("id") == F.col("node"), "left").select("doc_id", "n", F.coalesce("component", "id").alias("component_id"))
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_documents(spark, sf_dir))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest doc_id stays, with all its columns.

    Near duplicates share four fifths of their five-word shingles here; ``op6_jaccard_join`` keeps its own rule.
    """
    first = jaccard_components(docs, k=5, percent=80).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["kept_id"]), "left_semi")


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
