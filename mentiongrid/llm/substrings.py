r"""Removal of repeated word sequences: every word covered by `WINDOW` words that also start in a document
with a smaller doc_id.

1. *Chunks.* Each task sends a text once, by its SHA-256; chunks of about `chunk_bytes` are made of whole texts by digest.
   This one exchange of texts is shared by the three passes below, and nothing passes through the driver.
2. *Windows that recur.* A chunk sends its distinct window hashes, packed, to buckets of hash ranges. Hashes from
   several chunks go back to those chunks. This only spares most suffixes the way; a false alarm costs one row.
3. *Prefix-partitioned suffix trees.* A suffix is a place where a window of step 2 starts, cut after `WINDOW` words, and
   written as hashes of its first word, the next four and the last eight: the labels of the edges. Equal suffixes of a chunk travel as
   one. Suffixes are split into groups by prefixes of variable length: a prefix is extended word by word until so many words, at
   their frequency in the corpus, leave about `group_suffixes` per group. Groups come to their task in the order of the
   labels, and each subtree grows from left to right along its rightmost path, so neither a group nor its tree is ever
   held. An internal node of depth `WINDOW` is a repeat; the suffixes below it come by owner, so that the first has its least
   document, which is told to the chunks of all others.
4. *Removal.* The chunks mark all occurrences of these windows in documents after the least one.

Defined results: a null text has no word. A null doc_id counts as larger than all ids and equal to other nulls. Rows that
repeat a doc_id never remove each other's words. Of equal texts the smallest doc_id stands for all; the others lose every word
if they have at least `WINDOW`. Texts with fewer words stay as they are. A text longer than a chunk is a chunk.

Windows are compared by 64-bit hashes within a chunk, and by the labels of the edges (160 bits) across chunks. For very large
corpora raise `chunk_bytes` (64 MB, say) so that a packed list holds many hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import table
from mentiongrid.llm.wordhash import Runs, WordHashes, numbered, packed, pieces, stretches, unpacked
from mentiongrid.session import materialise

WINDOW = 13
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 6 << 20
GROUP_SUFFIXES = 1 << 18
#: Words below one in 2^RARE of all words count as if they were that frequent.
RARE = 12
_LAST = np.iinfo(np.int64).max
_SEEN = 200_000


def _binary(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def distinct_texts(documents: DataFrame, chunks: int) -> DataFrame:
    """(chunk, digest, owner, text): each text once for each task that has it, its least doc_id perhaps in a row without text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        later: dict[bytes, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for owner, data in zip(batch.column(0).to_pylist(), _binary(batch.column(1)), strict=True):
                digest = hashlib.sha256(data).digest()
                before = seen.get(digest)
                if before is None:
                    rows.append((digest, owner, data))
                    if len(seen) >= _SEEN:
                        rows += [(d, o, None) for d, o in later.items()]
                        seen, later = {}, {}
                    seen[digest] = owner
                elif owner < before:
                    seen[digest] = later[digest] = owner
            yield _rows(rows)
        yield _rows([(d, o, None) for d, o in later.items()])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        chunk = [int.from_bytes(d[:8], "big") % chunks for d in columns[0]]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, type=t) for c, t in zip([chunk, *columns], kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["chunk", "digest", "owner", "text"])

    owner = F.coalesce("doc_id", F.lit(int(_LAST)))
    sent = documents.select(owner.cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(run, "chunk long, digest binary, owner long, text binary")
    return sent.repartition("chunk")


class _Chunk:
    """The texts of one chunk by digest, and their windows, numbered over the whole chunk."""

    def __init__(self, rows: pa.Table) -> None:
        least: dict[bytes, int] = {}
        text: dict[bytes, bytes] = {}
        for digest, owner, data in zip(*(rows.column(c).to_pylist() for c in ("digest", "owner", "text")), strict=True):
            least[digest] = min(owner, least.get(digest, owner))
            if data is not None:
                text[digest] = data
        self.digests = sorted(text)
        self.owners = np.array([least[d] for d in self.digests], np.int64)
        self.texts = [text[d] for d in self.digests]
        known = WordHashes()
        each = [numbered(t, known, np.uint64) for t in self.texts]
        self.words = np.concatenate([*each, np.zeros(0, np.uint64)])
        sizes = np.array([len(e) for e in each], np.int64)
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        counts = np.maximum(sizes - WINDOW + 1, 0)
        self.doc = np.repeat(np.arange(len(sizes)), counts)  # by window
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        self.start = np.arange(before[-1]) - before[self.doc] + self.first[self.doc]  # of the window among all words
        self.runs = Runs(self.words)
        self.windows = self.runs.hashes(self.start, WINDOW)


def _send(chunk_rows: pa.Table, bits: int, buckets: int) -> pa.Table:
    chunk = _Chunk(chunk_rows)
    short = np.unique(chunk.windows >> np.uint64(64 - bits))
    bucket = ((short >> np.uint64(max(0, bits - 32))).astype(np.int64) * buckets) >> min(32, bits)
    which, cuts = stretches(bucket)
    lists = [packed(short[a:b], (bits + 7) // 8) for a, b in cuts]
    number = chunk_rows.column("chunk")[0].as_py()
    return pa.table({"bucket": which, "chunk": np.full(len(which), number), "hashes": pa.array(lists, pa.binary())})


def _recurring(rows: pa.Table, bits: int) -> pa.Table:
    """The hashes of a bucket that several chunks have, for each chunk that has them."""
    width = (bits + 7) // 8
    lists = [unpacked(x, width) for x in rows.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(lists))
    many = np.unique(every[1:][every[1:] == every[:-1]])
    answers = []
    for x in lists:
        at = np.minimum(np.searchsorted(many, x), max(0, len(many) - 1))
        answers.append(packed(x[many[at] == x], width) if len(many) else b"")
    found = pa.table({"chunk": rows.column("chunk"), "hashes": pa.array(answers, pa.binary())})
    return found.filter(pa.array([len(a) > 0 for a in answers]))


def _frequent_words(documents: DataFrame) -> tuple[dict[int, float], int]:
    """By hash, the bits of surprise of the words above one in 2^RARE, at most 2^RARE of them, and the number of all words.

    A batch names its words above half that share; this serves the sizes of groups only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            words = np.concatenate([np.zeros(0, np.uint64), *[numbered(t, known, np.uint64) for t in _binary(batch.column(0))]])
            word, n = np.unique(words, return_counts=True)
            often = n << (RARE + 1) >= len(words)
            word, n = np.append(word[often].view(np.int64), 0), np.append(n[often], len(words))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(np.arange(len(n)) == len(n) - 1)], ["word", "n", "total"])

    counts = documents.select(F.coalesce("text", F.lit(""))).mapInArrow(run, "word long, n long, total boolean")
    summed = materialise(counts.groupBy("word", "total").agg(F.sum("n").alias("n")), "word-counts")
    total = summed.where("total").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = summed.where(~F.col("total") & (F.col("n") * (1 << RARE) >= total)).toArrow()
    word, n = (often.column(c).to_numpy() for c in ("word", "n"))
    return dict(zip(word.view(np.uint64).tolist(), np.log2(total / n).tolist(), strict=True)), total


def _groups(chunk: _Chunk, start: np.ndarray, surprise: dict[int, float], enough: float) -> np.ndarray:
    """The hash of the prefix of variable length of the suffixes at `start`."""
    word, inverse = np.unique(chunk.words, return_inverse=True)
    bits = np.array([surprise.get(w, float(RARE)) for w in word.tolist()])[inverse]
    so_far, length = np.zeros(len(start)), np.full(len(start), WINDOW)
    for k in range(WINDOW - 1):
        so_far = so_far + bits[start + k]
        length = np.where((so_far >= enough) & (length == WINDOW), k + 1, length)
    return chunk.runs.hashes(start, length).view(np.int64)


def _suffixes(chunk_rows: pa.Table, replies: pa.Table, bits: int, surprise: dict[int, float], enough: float) -> pa.Table:
    """The distinct suffixes of a chunk that may start a repeat, with their least and greatest owner."""
    if not chunk_rows.num_rows:
        return _SUFFIX.empty_table()
    chunk = _Chunk(chunk_rows)
    shared = np.concatenate([np.zeros(0, np.uint64), *[unpacked(x, (bits + 7) // 8) for x in replies.column("hashes").to_pylist()]])
    _, first, inverse = np.unique(chunk.windows, return_index=True, return_inverse=True)
    owner = chunk.owners[chunk.doc]
    least, most = np.full(len(first), _LAST), np.full(len(first), np.iinfo(np.int64).min)
    np.minimum.at(least, inverse, owner)
    np.maximum.at(most, inverse, owner)
    wanted = np.isin(chunk.windows[first] >> np.uint64(64 - bits), shared) | (least < most)
    first, least, most = first[wanted], least[wanted], most[wanted]
    order = np.argsort(first)
    first, least, most = first[order], least[order], most[order]
    start = chunk.start[first]
    group = _groups(chunk, start, surprise, enough)
    edges = [chunk.runs.hashes(start + at, n).view(np.int64) for at, n in EDGES]
    number = np.full(len(first), chunk_rows.column("chunk")[0].as_py())
    columns = [(group >> 32).astype(np.int32), (edges[0] >> 32).astype(np.int32), *edges[1:], least, least < most, number, first.astype(np.int32)]
    return pa.table([pa.array(c) for c in columns], schema=_SUFFIX)


#: First word and number of words of the edges of a suffix.
EDGES = ((0, 1), (1, 4), (5, 8))
_SUFFIX = pa.schema([
    ("group", pa.int32()), ("edge_1", pa.int32()), ("edge_2", pa.int64()), ("edge_3", pa.int64()),
    ("owner", pa.int64()), ("several", pa.bool_()), ("chunk", pa.int64()), ("place", pa.int32()),
])
_SUFFIX_DDL = "group int, edge_1 int, edge_2 long, edge_3 long, owner long, several boolean, chunk long, place int"
_REPEAT = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("owners", pa.binary())])


class Subtrees:
    """Suffix trees of groups whose suffixes come in order: how deep the path of each is shared with the one before.

    A suffix leaves the rightmost path at the depth that it shares with the suffix before it, and an internal node stands
    there. Only what stands on the rightmost path is kept from batch to batch: the last suffix, and the owner of the
    first suffix below the last node of full depth.
    """

    def __init__(self) -> None:
        self._last: list[int] | None = None
        self._first_owner = 0

    def add(self, group_and_edges: list[np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Depth in words of the node above each suffix, as known from the left, and the owner of the first suffix below a deep node."""
        n = len(owner)
        same = np.ones(n, bool)
        depth = np.zeros(n, np.int64)
        for i, (values, words) in enumerate(zip(group_and_edges, (0, *(size for _, size in EDGES)), strict=True)):
            same[1:] &= values[1:] == values[:-1]
            same[:1] &= self._last is not None and self._last[i] == values[0] if n else False
            depth[same] += words
        starts = depth < WINDOW
        index = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
        least = np.where(index >= 0, owner[np.maximum(index, 0)], self._first_owner)
        if n:
            self._last, self._first_owner = [int(v[-1]) for v in group_and_edges], int(least[-1])
        return depth, least


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by group, edges and owner; told are the places of windows that have a smaller owner elsewhere."""
    trees, held, size = Subtrees(), [], 0
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        owner, several, chunk, place = columns[4:]
        _, least = trees.add(columns[:4], owner)
        tell = (least < owner) | several
        held.append((chunk[tell], place[tell], least[tell]))
        size += int(tell.sum())
        if size > 500_000:
            yield _told(held)
            held, size = [], 0
    yield _told(held)


def _told(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    chunk, place, owner = (np.concatenate([np.zeros(0, np.int64), *arrays]) for arrays in (zip(*held, strict=True) if held else ([], [], [])))
    order = np.argsort(chunk, kind="stable")
    chunk, place, owner = chunk[order], place[order], owner[order]
    chunks, cuts = stretches(chunk)
    columns = [pa.array(chunks), *(pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary()) for values in (place, owner))]
    return pa.RecordBatch.from_arrays(columns, schema=_REPEAT)


def _removed(chunk_rows: pa.Table, repeats: pa.Table, with_text: bool) -> pa.Table:
    schema = pa.schema([
        ("digest", pa.binary()), ("owner", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
    ])
    if not chunk_rows.num_rows:
        return schema.empty_table()
    chunk = _Chunk(chunk_rows)
    cover = np.zeros(len(chunk.words) + 1, np.int64)
    if repeats.num_rows and len(chunk.windows):
        place, owner = (np.concatenate([np.frombuffer(x, np.int64) for x in repeats.column(c).to_pylist()]) for c in ("places", "owners"))
        _, inverse = np.unique(chunk.windows, return_inverse=True)
        least = np.full(inverse.max() + 1, _LAST)
        np.minimum.at(least, inverse[place], owner)
        start = chunk.start[least[inverse] < chunk.owners[chunk.doc]]
        np.add.at(cover, start, 1)
        np.add.at(cover, start + WINDOW, -1)
    keep = np.cumsum(cover)[:-1] == 0
    columns: list[list] = [[], [], [], []]
    for doc, data in enumerate(chunk.texts):
        stays = keep[chunk.first[doc] : chunk.first[doc + 1]]
        digest, parts, at = hashlib.sha256(), [], 0
        begun = False
        for piece in pieces(data):
            words = piece.split()
            here = stays[at : at + len(words)]
            at += len(words)
            left = words if here.all() else [words[i] for i in np.flatnonzero(here).tolist()]
            if left:
                text = b" " * begun + b" ".join(left)
                begun = True
                digest.update(text)
                if with_text:
                    parts.append(text)
        for column, value in zip(columns, (len(stays), len(stays) - int(stays.sum()), digest.hexdigest(), b"".join(parts).decode("utf-8", "replace") if with_text else None), strict=True):
            column.append(value)
    return pa.table([pa.array(chunk.digests, pa.binary()), pa.array(chunk.owners), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]], schema=schema)


def remove_repeats(
    documents: DataFrame, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]), one row per row of (doc_id, text)."""
    documents = documents.select("doc_id", "text")
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]  # one number
    surprise, n_words = _frequent_words(documents)
    enough = max(1.0, float(np.log2(max(1, n_words) / group_suffixes)))
    bits = min(64, 8 + int(size).bit_length())  # one in a thousand hashes recurs by chance
    buckets = 1 + size // bucket_bytes
    texts = distinct_texts(documents, 1 + size // chunk_bytes)
    frequent = documents.sparkSession.sparkContext.broadcast(surprise)

    sent = texts.groupBy("chunk").applyInArrow(lambda t: _send(t, bits, buckets), "bucket long, chunk long, hashes binary")
    replies = sent.groupBy("bucket").applyInArrow(lambda t: _recurring(t, bits), "chunk long, hashes binary")
    suffixes = texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda t, r: _suffixes(t, r, bits, frequent.value, enough), _SUFFIX_DDL
    )
    in_order = suffixes.repartition("group").sortWithinPartitions("group", "edge_1", "edge_2", "edge_3", "owner")
    repeats = in_order.mapInArrow(_grow, "chunk long, places binary, owners binary")
    found = texts.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(
        lambda t, r: _removed(t, r, with_text), "digest binary, owner long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    rows = documents.select("doc_id", F.unhex(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)).alias("digest"))
    joined = rows.join(found, "digest")
    copy = (F.coalesce("doc_id", F.lit(int(_LAST))) > F.col("owner")) & (F.col("n_words") >= WINDOW)
    done = [
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        done.append(F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"))
    return joined.select(*done)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(doc_id, 9223372036854775807) AS owner,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT row_no, owner, i, array_to_string(words[i:i + 12], ' ') AS seq
    FROM docs, unnest(range(1, len(words) - 11)) AS u(i)
), least AS (
    SELECT seq, min(owner) AS least FROM windows GROUP BY seq HAVING min(owner) < max(owner)
), gone AS (
    SELECT DISTINCT row_no, i + k AS spot FROM windows JOIN least USING (seq), range(13) AS r(k) WHERE owner > least
), dropped AS (
    SELECT row_no, list(spot) AS places FROM gone GROUP BY row_no
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_select(words, list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p))) END, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN dropped USING (row_no)
"""

QUERIES = {"op11_substring_dedup": op11_substring_dedup}
SQL: dict[str, str] = {"op11_substring_dedup": _SQL}
