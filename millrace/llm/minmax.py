"""Near-duplicate groups by min-max hashing of word shingles.

Every permutation of the shingle hashes yields two signature values, the smallest and the
largest image, so a signature of 2k values costs k hash evaluations per shingle. The values
are cut into bands; documents that agree on a band are candidates.

Links are confirmed on the full shingle sets, and no link that a band proposes is lost, yet
the pairs of a bucket are never all formed:

1. Documents with equal sets are one node.
2. Each node of a bucket is compared with the bucket's centre, the node that shares most
   buckets with others: a star. What is then not in its centre's component is far. The far
   nodes of a bucket are compared with a centre of their own.
3. A far node u is compared with a node y of another component only if that can be a link.
   With |u & c| and |y & c| known for the centre c, a link needs a certain overlap of u and
   y, of which c can give at most the smaller of the two. What is missing must be shared
   shingles outside of c, found by a join on such shingles (prefixes, the rarest first); nothing
   can be missing only if y is small enough, found by a join on sizes.

A bucket whose nodes all hang together, however many, therefore costs one comparison a node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import WordHashes, ascii_words, mix, shingle_set, slices, written
from millrace.llm.components import connected_components

BAND_ROWS = 5
MISS = 1e-6


def band_count(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold is overlooked with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


class Signer:
    """Min-max signatures of shingle sets, as one 64-bit key for each band."""

    def __init__(self, bands: int, rows: int = BAND_ROWS, seed: int = 7):
        random = np.random.default_rng(seed)
        permutations = (bands * rows + 1) // 2
        self.bands, self.rows = bands, rows
        self.factors = random.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = random.integers(0, 2**64, permutations, dtype=np.uint64)

    def values(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row for each set: all minima, then all maxima. Sets must not be empty."""
        joined = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        out = np.empty((len(sets), 2 * len(self.factors)), np.uint64)
        for i, (factor, shift) in enumerate(zip(self.factors, self.shifts)):
            image = joined * factor + shift
            out[:, i] = np.minimum.reduceat(image, starts)
            out[:, len(self.factors) + i] = np.maximum.reduceat(image, starts)
        return out

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        values = self.values(sets)[:, :self.bands * self.rows].reshape(len(sets), self.bands, self.rows)
        keys = np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys = np.broadcast_to(keys, values.shape[:2])
        for i in range(self.rows):
            keys = mix(keys ^ values[:, :, i])
        return keys.view(np.int64)


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their sets of
    ``width``-word shingles. ``component_id`` is the smallest id reachable over links.

    Null or wordless texts have an empty set, are linked with nothing and are kept. Null ids
    never name a group that has another id; a row with a null id is kept only if its group
    has none. Rows that repeat an id are rows like others. Other columns are ignored; an
    empty table gives no rows. Texts of any length are taken whole.
    """
    grouped = _grouped(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), percent, width)
    least = grouped.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = grouped.join(least, "component", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def first_of_groups(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The rows of ``docs`` (with ``doc_id`` and ``text``) without near duplicates.

    Of each group the row with the smallest id stays, null ids last; among rows with that id
    one is chosen by a digest of its text, and of rows that repeat both, any one. Null and
    wordless texts all stay. All columns are kept.
    """
    grouped = _grouped(docs.select("doc_id", "text"), percent, width)
    first = (grouped.where("n_shingles > 0").groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
             .select(F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")))
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("row"), docs["doc_id"].alias("id"), _text_key(docs["text"]).alias("key"),
                        (F.length(F.btrim(F.coalesce(docs["text"], F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0).alias("worded"))
    chosen = (keyed.where("worded").join(first, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
              .dropDuplicates(["id", "key"]).select("row"))
    out = chosen.union(keyed.where("not worded").select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _text_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _grouped(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, component`` for each row; no component without words."""
    rows = written(_signed(docs, band_count(percent), width), "signatures")
    # Equal sets are one node from here on.
    nodes = (rows.where("n_shingles > 0").groupBy("node")
             .agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    members = nodes.select("node", "n", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    members = written(members.join(buckets.where("size > 1"), "key"), "members")
    known = members.groupBy("node").agg(F.sum("size").alias("weight"))
    members = members.drop("size").join(known, "node")
    members = written(members.join(_centres(members), "key"), "members")
    wanted = members.select("node").distinct()
    payload = written(rows.where("payload is not null").select("node", "payload").join(wanted, "node", "left_semi")
                      .groupBy("node").agg(F.first("payload").alias("payload")), "payload")

    def star(around: DataFrame) -> DataFrame:
        return around.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()

    compared = written(_compare(star(members), payload, width), "compared")
    links = written(compared.where(_is_link(percent)).select("a", "b"), "links")
    components = written(connected_components(links), "components")
    far = _named(members, components).where("component <> home").select("key", "node", "weight")
    again = _compare(star(far.join(_centres(far), "key")), payload, width)
    components = _joined(components, again.where(_is_link(percent)))
    open_ = written(_open_pairs(members, components, compared, payload, percent, width), "open")
    components = _joined(components, _compare(open_, payload, width).where(_is_link(percent)))
    return (rows.select("doc_id", "text_key", "n_shingles", "node").join(components, "node", "left")
            .select("doc_id", "text_key", "n_shingles", F.coalesce("component", "node").alias("component")))


def _centres(members: DataFrame) -> DataFrame:
    """For each bucket the node of the largest weight."""
    best = members.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best"))
    return best.select("key", F.col("best.node").alias("centre"))


def _joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links between nodes."""
    stars = components.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return written(connected_components(stars.union(links.select("a", "b"))), "components")


def _named(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Rows (node, centre) with the component of each, ``component`` and ``home``."""
    homes = components.select(F.col("node").alias("centre"), F.col("component").alias("home"))
    return (rows.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
            .join(homes, "centre", "left").withColumn("home", F.coalesce("home", "centre")))


def _signed(docs: DataFrame, bands: int, width: int) -> DataFrame:
    docs = docs.select("doc_id", "text", _text_key(docs["text"]).alias("text_key"))
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, n_shingles bigint, node binary, "
              "bands array<bigint>, payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, hashes, pack = Signer(bands), WordHashes(), zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sets, payload, seen = [], [], set()
            for text in texts:
                words = ascii_words(text or b"")
                sets.append(shingle_set(words, hashes, width))
                payload.append(b" ".join(words))
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            # A set's words are needed once; copies in the same batch leave them out.
            for i, node in enumerate(nodes):
                payload[i] = pack.compress(payload[i]) if node is not None and node not in seen else None
                seen.add(node)
            filled = [i for i, s in enumerate(sets) if len(s)]
            keys = [None] * len(sets)
            if filled:
                for i, row in zip(filled, signer.keys([sets[i] for i in filled])):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(payload, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "node", "bands", "payload"])

    return docs.mapInArrow(run, schema)


def _is_link(percent: int):
    return F.expr(f"100 * shared >= {percent} * either")


class _Sets:
    """Shingle sets of packed texts; the last centre's set is kept, as rows come by centre."""

    def __init__(self, width: int):
        self.hashes, self.unpack, self.width, self.last = WordHashes(), zstandard.ZstdDecompressor(), width, (None, None)

    def __call__(self, packed: bytes) -> np.ndarray:
        return shingle_set(self.unpack.decompress(packed).split(b" "), self.hashes, self.width)

    def kept(self, node: bytes, packed: bytes) -> np.ndarray:
        if self.last[0] != node:
            self.last = (node, self(packed))
        return self.last[1]


def _compare(pairs: DataFrame, payload: DataFrame, width: int) -> DataFrame:
    """``a, b, shared, either``: sizes of intersection and union of the full sets."""
    joined = (pairs.join(payload.select(F.col("node").alias("a"), F.col("payload").alias("left")), "a")
              .join(payload.select(F.col("node").alias("b"), F.col("payload").alias("right")), "b")
              .select("a", "b", "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(width)
        for batch in slices(batches):
            a, b, left, right = (c.to_pylist() for c in batch.columns)
            shared, either = [], []
            for i in range(len(a)):
                own, centre = sets(left[i]), sets.kept(b[i], right[i])
                place = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                both = int((centre[place] == own).sum())
                shared.append(both)
                either.append(len(own) + len(centre) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(either, pa.int64())],
                names=["a", "b", "shared", "either"])

    return joined.mapInArrow(run, "a binary, b binary, shared bigint, either bigint")


def _open_pairs(members: DataFrame, components: DataFrame, compared: DataFrame, payload: DataFrame,
                percent: int, width: int) -> DataFrame:
    """Pairs around one centre that may be linked and are not connected yet.

    For a link, 100 * |u & y| >= percent * |u | y|, so |u & y| >= need(|u| + |y|) with
    need = percent / (100 + percent). Of that the centre gives at most min(|u & c|, |y & c|).
    """
    need = percent / (100 + percent)
    sizes = members.select("node", "n").distinct()
    around = _named(compared.select(F.col("a").alias("node"), F.col("b").alias("centre"), "shared"), components)
    around = around.join(sizes, "node")
    reached = around.where("component <> home").select("centre").distinct()
    # What any link of the node needs beyond the centre; a partner has at least percent of its size.
    around = written(around.join(reached, "centre").withColumn(
        "beyond", F.ceil(F.col("n") * percent / 100 - 1e-9) - F.col("shared")), "around")
    outside = written(_outside(around.select(F.col("node").alias("a"), F.col("centre").alias("b"), "beyond"),
                               payload, width), "outside")
    facts = ["node", "centre", "component", "home", "n", "shared"]
    outside = written(_rare_prefixes(outside), "prefixes").join(around.select(*facts), ["node", "centre"])
    step = 0.04
    bin_of = lambda size: F.floor(F.log(size) / step).cast("int")
    # Without sharing anything beyond the centre, y must be this small.
    most = F.col("shared") / need - F.col("n") + 1e-6
    least = F.col("n") * percent / 100 - 1e-6
    small = around.where((F.col("component") != F.col("home")) & (most >= least)).withColumn(
        "bin", F.explode(F.sequence(bin_of(least), bin_of(most))))
    wanted = (f"x_component <> y_component and (y_component = y_home or x_node < y_node) "
              f"and 100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)")
    lacking = f"{need} * (x_n + y_n) - least(x_shared, y_shared) - 1e-6"

    def sided(side: str, rows: DataFrame, on: list[str]) -> DataFrame:
        return rows.select(*on, *[F.col(c).alias(f"{side}_{c}") for c in rows.columns if c not in on])

    on = ["centre", "list"]
    found = sided("x", outside.where("component <> home"), on).join(sided("y", outside, on), on).where(wanted)
    # Shared shingles in both prefixes are counted; others lie behind one of the two.
    found = (found.groupBy("centre", "x_node", "y_node")
             .agg(F.sum(F.least("x_weight", "y_weight")).alias("met"), F.first(F.greatest("x_behind", "y_behind")).alias("behind"),
                  F.first(F.expr(lacking)).alias("lacking")).where("met + behind >= lacking"))
    on = ["centre", "bin"]
    alike = sided("x", small, on).join(sided("y", around.withColumn("bin", bin_of(F.col("n"))), on), on)
    alike = alike.where(f"{wanted} and {lacking} <= 0")
    pair = [F.greatest("x_node", "y_node").alias("a"), F.least("x_node", "y_node").alias("b")]
    return found.select(*pair).union(alike.select(*pair)).distinct()


def _rare_prefixes(outside: DataFrame) -> DataFrame:
    """``node, centre, list, weight, behind``: prefixes of at least ``upto`` shingles, rarest first.

    Nodes that share enough shingles share one of their prefixes if all prefixes follow one
    order. Here it is the count around the centre, so a passage of many nodes comes last.
    Shingles that the same nodes have are one entry, ``list``, with their number, ``weight``;
    an entry is in a prefix with all its shingles. A shingle that only one node has takes its
    place in the prefix, but joins nothing. ``behind`` shingles of the node follow its prefix.
    """
    lists = (outside.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"), F.bit_xor(F.xxhash64("node")).alias("list"))
             .where("often > 1"))
    met = outside.join(lists, "shingle").groupBy("node", "centre", "often", "list").agg(
        F.count(F.lit(1)).alias("weight"), F.first("upto").alias("upto"), F.first("size").alias("size"))
    own = Window.partitionBy("node", "centre")
    met = (met.withColumn("met", F.sum("weight").over(own))
           .withColumn("before", F.sum("weight").over(own.orderBy("often", "list")) - F.col("weight")))
    # The shingles of one node alone come first.
    met = met.withColumn("within", F.expr("before < upto - (size - met)"))
    behind = F.col("met") - F.sum(F.when(F.col("within"), F.col("weight")).otherwise(0)).over(own)
    return met.withColumn("behind", behind).where("within").select("node", "centre", "list", "weight", "behind")


def _outside(pairs: DataFrame, payload: DataFrame, width: int) -> DataFrame:
    """``node, centre, shingle, size, upto``: the ``size`` shingles of the node outside of the
    centre's set. Two nodes that share ``beyond`` of them share one of the first ``upto``, in
    any common order. ``shingle`` is a hash that differs from centre to centre."""
    joined = (pairs.join(payload.select(F.col("node").alias("a"), F.col("payload").alias("left")), "a")
              .join(payload.select(F.col("node").alias("b"), F.col("payload").alias("right")), "b")
              .select("a", "b", "left", "right", "beyond"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(width)
        for batch in slices(batches):
            a, b, left, right, beyond = (c.to_pylist() for c in batch.columns)
            rows, shingles, sizes = [], [], []
            for i in range(len(a)):
                own, centre = sets(left[i]), sets.kept(b[i], right[i])
                rest = np.setdiff1d(own, centre, assume_unique=True)
                rest = rest if len(rest) >= beyond[i] else rest[:0]
                rows.append(np.full(len(rest), i))
                shingles.append(mix(rest ^ np.uint64(xxhash.xxh3_64_intdigest(b[i]))))
                sizes.append(len(rest))
            rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
            sizes = np.array(sizes, np.int32)[rows]
            upto = sizes - np.maximum(np.array(beyond, np.int64), 1)[rows] + 1
            codes = np.concatenate(shingles).view(np.int64) if shingles else []
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(codes, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(upto, pa.int32())],
                names=["node", "centre", "shingle", "size", "upto"])

    return joined.mapInArrow(run, "node binary, centre binary, shingle bigint, size int, upto int")
