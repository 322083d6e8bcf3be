r"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, components.

1. *Signatures.* A text, A-Z lower-cased, is cut into words; its set is the distinct runs of five words
   (all words as one run if they are fewer). `BANDS` bands of `ROWS` MinHash samples find a pair at
   similarity 0.75 with a chance of 1 - (1 - 0.75^5)^56, that is, all but 3 in ten million. The samples
   also fold into an odd sketch: every sample flips one bit of `SKETCH_BITS`, so the XOR of two sketches
   has about m/2 (1 - exp(-4k(1-J)/m)) bits set for k samples, which estimates high similarities J well.
2. *Classes.* Texts with equal sets share a 128-bit fingerprint and are one node from here on.
3. *Stars before pairs.* In each band bucket all members are compared with one centre, not with each
   other: first with the least one over a few bands, then, over all bands and only across components
   found so far, with the member that has most links. Buckets that still hold several components are
   then compared whole, in blocks of at most two chunks of some 512 members, so that every link that can
   join two components is tried; there no pair becomes a row, only confirmed links do.
4. *Candidate filter.* A pair must agree in size within 3/4 and its sketches must not show a similarity
   below `SKETCH_LEAST`, more than five standard deviations under 0.75.
5. *Confirmation.* Survivors are confirmed on the full sets of word runs. Blocks of at most some 256
   members are sent with their centre's text and streamed in order.
6. *Components* by hooking to the least neighbour and contracting the links, all in joins.

Defined results: a text that is null or has no word has an empty set and links with nothing. Rows
with equal sets are linked whatever their ids; a repeated doc_id is compared as any other row. A null
doc_id takes part, but never names a component that has an id. `component_id` is null only if
no member has an id; `kept` compares null-safely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import annotate, row_key, table
from mentiongrid.session import materialise, scratch

WORDS, ROWS, BANDS = 5, 5, 56
SKETCH_BITS = 2048
SKETCH_LEAST = 0.6
NEED, OF = 75, 100
_SAMPLES = ROWS * BANDS
_FIRST_BANDS = 8
_BLOCK = 256
_CHUNK = 512
_CACHE = 200_000


def words_of(text: str) -> list[bytes]:
    # bytes.lower() changes A-Z only, bytes.split() cuts at the six ASCII blanks only.
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(WORDS)], strict=False))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs."""
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(WORDS, len(words))
    mixed = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        mixed = (mixed ^ each[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 32, _SAMPLES, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, _SAMPLES, dtype=np.uint32)


_A, _B = _factors()
_WHICH = np.arange(_SAMPLES, dtype=np.uint64)


def samples_of(hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that is not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(_SAMPLES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(x), 256):
        np.minimum(least, (x[start : start + 256, None] * _A + _B).min(0), out=least)
    return least


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bits of the samples as int64 words."""
    bit = _mixed(samples.astype(np.uint64) * np.uint64(_SAMPLES) + _WHICH) % np.uint64(SKETCH_BITS)
    odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_bits(similarity: float) -> int:
    """The number of bits of the XOR of two sketches that is expected at this similarity."""
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * _SAMPLES * (1 - similarity))))


def signatures(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands, sketch) per row; node is null for an empty set."""

    def work(texts):
        known = _WordHashes()
        for text in texts:
            hashes = shingle_hashes(words_of(text), known) if text else []
            if not len(hashes):
                yield 0, None, None, None
                continue
            samples = samples_of(hashes)
            yield len(hashes), xxhash.xxh128_digest(hashes.tobytes()), band_keys(samples), odd_sketch(samples)

    keyed = documents.select(*row_key("text"), "text")
    found = annotate(keyed, ["doc_id", "text_hash"], ["text"], work, "n long, node binary, bands array<long>, sketch array<long>")
    return found.select("row.*", "n", "node", "bands", "sketch")


def _shared_bands(signed: DataFrame) -> DataFrame:
    """(key, band, node, n) of the band buckets that hold at least two nodes."""
    keyed = signed.where("node is not null").select("node", "n", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    return keyed.join(shared, "key").select("key", "band", "node", "n").distinct()


def _similar_size(a: str, b: str) -> Column:
    return (OF * F.col(a) >= NEED * F.col(b)) & (OF * F.col(b) >= NEED * F.col(a))


def _stars(bands: DataFrame, labels: DataFrame | None, links: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of each bucket's centre and its members, across components if these are known."""
    if labels is None:
        low = bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("c"))
        joined = bands.join(low, "key").withColumns({"label": F.col("node"), "c_label": F.col("c.node")})
    else:
        degrees = links.select("a").unionAll(links.select("b")).groupBy("a").count().withColumnsRenamed({"a": "node", "count": "degree"})
        bands = _labelled(bands, labels).join(degrees, "node", "left")
        ranked = F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "node", "n", "label"))
        centre = bands.groupBy("key").agg(ranked.alias("c"), F.min("label").alias("low"), F.max("label").alias("high"))
        joined = bands.join(centre.where("low < high").select("key", "c"), "key").withColumn("c_label", F.col("c.label"))
    across = joined.where(F.col("label") != F.col("c_label")).withColumn("cn", F.col("c.n")).where(_similar_size("n", "cn"))
    return _pairs(across.select(F.col("c.node").alias("x"), F.col("node").alias("y")))


def _labelled(bands: DataFrame, labels: DataFrame) -> DataFrame:
    return bands.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def _pairs(xy: DataFrame) -> DataFrame:
    return xy.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open_blocks(bands: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, in blocks of two chunks of a bucket.

    (key, low, high, chunk, node, label, n, sketch): two members of a bucket meet in one block.
    """
    labelled = _labelled(bands, labels)
    spread = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("size"))
    chunks = spread.where("least < most").select("key", F.ceil(F.col("size") / _CHUNK).alias("chunks"))
    members = labelled.join(chunks, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    members = members.join(nodes.select("node", "sketch"), "node")
    each = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return each.select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "label", "n", "sketch")


_BLOCK_KEY = ["key", "low", "high"]


def _across(bands: DataFrame, labels: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """(a, b): links between components, from all pairs of members of a bucket.

    No pair becomes a row. Blocks of sketches tell which members may have a link in their block; only these are
    sent again with their texts, and only confirmed links leave.
    """
    blocks = _open_blocks(bands, labels, nodes).repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY)
    kinds = "key long, low long, high long, chunk long, node binary, label binary, n long, sketch array<long>"
    hopeful = materialise(blocks.mapInArrow(_hopeful, kinds), "hopeful")
    sent = _with_texts(hopeful, nodes, documents).select(*hopeful.columns, "text")
    return sent.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY).mapInArrow(_linked, "a binary, b binary").distinct()


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time, from rows in the order of the blocks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(i).to_numpy() for i in range(3)])
        if held:
            ids = np.concatenate([np.array([[held[-1].column(i)[-1].as_py()] for i in range(3)]), ids], 1)
        cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + (0 if held else 1)
        at = 0
        for cut in cuts.tolist():
            done = [*held, batch.slice(at, cut - at)]
            held, at = [], cut
            yield pa.Table.from_batches([b for b in done if b.num_rows])
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(block: pa.Table) -> np.ndarray:
    """Which rows of a block may be linked: different components, similar size, and near sketches."""
    chunk, n = block.column(3).to_numpy(), block.column(6).to_numpy()
    label = np.unique(block.column(5).to_pylist(), return_inverse=True)[1]
    sketch = block.column(7).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(n), -1)  # counts of signed numbers are of their absolute values
    fits = (label[:, None] < label[None, :]) & (OF * n[:, None] >= NEED * n[None, :]) & (OF * n[None, :] >= NEED * n[:, None])
    if block.column(1)[0].as_py() != block.column(2)[0].as_py():
        fits &= chunk[:, None] != chunk[None, :]
    a, b = np.nonzero(fits)
    near = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 15):
        x = sketch[a[k : k + (1 << 15)]] ^ sketch[b[k : k + (1 << 15)]]
        near[k : k + (1 << 15)] = np.bitwise_count(x).sum(1) <= most_bits(SKETCH_LEAST)
    return np.stack([a[near], b[near]], 1)


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _by_block(batches):
        rows = np.unique(_candidates(block))
        if len(rows):
            yield from block.take(pa.array(rows)).combine_chunks().to_batches()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _by_block(batches):
        nodes, labels = block.column(4).to_pylist(), block.column(5).to_pylist()
        sets = [shingle_set(words_of(t)) for t in block.column(8).to_pylist()]
        joined, ends = set(), []
        for i, j in _candidates(block).tolist():
            if (labels[i], labels[j]) in joined:
                continue  # one link joins two components
            both = len(sets[i] & sets[j])
            if OF * both >= NEED * (len(sets[i]) + len(sets[j]) - both):
                joined.add((labels[i], labels[j]))
                ends.append(sorted((nodes[i], nodes[j])))
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.binary()) for k in (0, 1)], ["a", "b"])


def _with_texts(rows: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """`rows` with the text of their `node`."""
    keys = nodes.select("node", F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    wanted = rows.join(keys, "node")
    needed = wanted.select("k_id", "k_hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("k_id")) & F.col("text_hash").eqNullSafe(F.col("k_hash"))
    texts = documents.select(*row_key("text"), "text").join(needed, same, "left_semi")
    texts = texts.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    return wanted.join(texts, same)


def _sketched(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose odd sketches allow the similarity that is asked for."""
    words = SKETCH_BITS // 64
    a, b = (nodes.select(F.col("node").alias(s), F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
    differ = sum((F.bit_count(F.get("sketch_a", F.lit(i)).bitwiseXOR(F.get("sketch_b", F.lit(i)))) for i in range(words)), F.lit(0))
    return pairs.join(a, "a").join(b, "b").where(differ <= most_bits(SKETCH_LEAST)).select("a", "b")


def _confirmed(pairs: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The end that occurs in more pairs is the centre; its members are dealt into blocks.
    """
    counts = pairs.select("a").unionAll(pairs.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("uses"))
    counts = materialise(counts, "pair-counts")
    ua, ub = counts.withColumnsRenamed({"uses": "ua"}), counts.withColumnsRenamed({"a": "b", "uses": "ub"})
    turned = pairs.join(ua, "a").join(ub, "b")
    first = F.col("ua") >= F.col("ub")
    stars = turned.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("centre"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("node"),
        F.ceil(F.greatest("ua", "ub") / _BLOCK).alias("blocks"),
    )
    members = stars.select("node", "centre", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.lit(1).alias("role"))
    members = materialise(members, "pair-members")
    centres = members.select(F.col("centre").alias("node"), "centre", "block", F.lit(0).alias("role")).distinct()
    sent = _with_texts(members.unionByName(centres), nodes, documents).select("centre", "block", "role", "node", "text")
    in_order = sent.repartition("centre", "block").sortWithinPartitions("centre", "block", "role")
    return in_order.mapInArrow(_compare, "a binary, b binary")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, the centre's first."""
    centre: set = set()
    for batch in batches:
        a, b = [], []
        for i in range(batch.num_rows):
            mine = shingle_set(words_of(batch.column(4)[i].as_py()))
            if batch.column(2)[i].as_py() == 0:
                centre = mine
                continue
            both = len(centre & mine)
            if OF * both >= NEED * (len(centre) + len(mine) - both):
                ends = sorted((batch.column(0)[i].as_py(), batch.column(3)[i].as_py()))
                a.append(ends[0])
                b.append(ends[1])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node with a link: the least node it reaches. `labels` are known roots."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if labels is not None:
        known_a, known_b = (labels.withColumnsRenamed({"node": s, "root": f"r{s}"}) for s in "ab")
        mapped = both.join(known_a, "a", "left").join(known_b, "b", "left")
        ends = mapped.select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        edges = ends.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        fresh = both.select(F.col("a").alias("node")).distinct().join(labels, "node", "left_anti")
        known = labels.unionByName(fresh.withColumn("root", F.col("node")))
    else:
        edges = both.distinct()
        known = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node"))
    edges = materialise(edges, "links")
    jumps: list[DataFrame] = []
    while not edges.isEmpty():
        hook = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        onward = hook.select(F.col("a").alias("to"), F.col("to").alias("next"))
        jump = materialise(hook.join(onward, "to").select("a", F.col("next").alias("to")), "jumps")
        moved = edges.join(jump, "a").select(F.col("to").alias("a"), "b").join(jump.withColumnsRenamed({"a": "b", "to": "tb"}), "b")
        edges = materialise(moved.select("a", F.col("tb").alias("b")).where("a != b").distinct(), "links")
        jumps.append(jump)
    # Where every node has gone is told once, by all jumps in turn; a table more of them for each doubling of a chain.
    for jump in jumps:
        known = known.join(jump.withColumnsRenamed({"a": "root"}), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialise(known, "labels")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, text_hash, n_shingles, component_id, kept; a stored table."""
    with scratch(documents.sparkSession, "near-duplicates") as keep:
        return keep(_near_duplicates(documents.select("doc_id", "text")))


def _near_duplicates(documents: DataFrame) -> DataFrame:
    signed = materialise(signatures(documents).withColumn("row_id", F.monotonically_increasing_id()), "signatures")
    rows = signed.where("node is not null")
    first = rows.groupBy("node").agg(F.min("row_id").alias("row_id"), F.min("doc_id").alias("least_id"))
    nodes = materialise(rows.select("row_id", "n", "doc_id", "text_hash", "sketch").join(first, "row_id"), "nodes")
    bands = materialise(_shared_bands(signed), "bands")

    def round_(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = materialise(pairs, "pairs")
        return pairs, materialise(_confirmed(materialise(_sketched(pairs, nodes), "candidates"), nodes, documents), "confirmed")

    tried, links = round_(_stars(bands.where(F.col("band") < _FIRST_BANDS), None, None))
    labels = components(links)
    _, new = round_(_stars(bands, labels, links).join(tried, ["a", "b"], "left_anti"))
    labels = components(new, labels)
    labels = components(materialise(_across(bands, labels, nodes, documents), "confirmed"), labels)

    ids = nodes.select("node", "least_id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = ids.join(found, "root").select("node", F.col("component_id").alias("joined_id"))
    done = signed.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("joined_id"))
    return done.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


QUERIES = {"op4_near_duplicates": op4_near_duplicates}
SQL: dict[str, str] = {}
