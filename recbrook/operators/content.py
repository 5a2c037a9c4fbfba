"""Content vectors of users and posts in one space: a randomised SVD of the
texts' term weights, fitted on both sides together.

``X`` holds a row per text and a column per term, ``(1 + ln tf)`` scaled to unit
rows times the term's idf.  Neither ``X`` nor a vocabulary is ever gathered:

Texts are kept in blocks of about ``BLOCK`` tokens, a row each: the block's own
terms, and of every text the places of its terms among them with their counts:

1. ``Y = X R`` for a thin random sign matrix ``R`` whose row is read off the
   bits of the term's hash (``SKETCH`` sums per text, no stored matrix);
2. the Gram matrix of ``Y`` (``SKETCH`` squared numbers, summed over partitions)
   gives an orthonormal basis ``Q`` of its range;
3. terms are dealt by hash to ranges of some ``RANGE``.  A block hands each range its
   counts there and the rows of ``Q`` of the texts they are of, so what moves is a vector per
   text and range, never one per text or block and term.  A task sums its range's rows
   of ``B' = X' Q`` and holds no more than those;
4. the Gram matrix of ``B'`` gives the singular values, so each term gets its
   projection.  Only two small square matrices reach the driver.

The same pass meets every block's counts a second time, when its range's sums stand, and
hands each text its part of ``X B'``; the parts of all ranges, turned by the singular
vectors, are the text's vector.  For texts that come later the term table is the model
(``fit_terms``, ``project``): projecting them is a join on their terms.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import SHUFFLE_CLEANUP, scratch_path

# Fixed value: width of the vectors.
EMBEDDING_DIM = 32
#: Columns of the random sketch; the bits of one 64-bit hash are its signs.
SKETCH = 48
#: Tokens aimed at per block of texts, of which each counts as so many more (its sketch is as
#: long); entries summed at once.
BLOCK, PER_TEXT, ENTRIES = 500_000, SKETCH, 100_000
#: Terms, and entries of (text, term), of a range at most.
RANGE, SHARE = 400_000, 1 << 28


BLOCK_COLUMNS = "block bigint, side array<string>, id array<bigint>, known array<boolean>, start array<int>, at array<int>, tf array<int>, term array<string>"


def summed(arrays: DataFrame, column: str) -> np.ndarray:
    """Element-wise sum of an array<double> column, one row per element: what
    reaches the driver is as long as one array, however many rows there are."""
    rows = (arrays.select(F.posexplode(column).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(len(rows))
    for r in rows:
        out[r.i] = r.v
    return out


def gram(df: DataFrame, column: str, width: int) -> np.ndarray:
    """``V' V`` of the vectors in ``column``: one partial matrix a task."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = np.zeros((width, width))
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf[column].to_numpy())
                g += v.T @ v
        yield pd.DataFrame({"g": [g.ravel()]})

    total = summed(df.select(column).mapInPandas(partial, "g array<double>"), "g")
    return total.reshape(width, width) if len(total) else np.zeros((width, width))


def spectrum(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the part of ``g`` above rounding, largest
    first; each vector's largest entry is positive."""
    val, vec = np.linalg.eigh(g)
    keep = val > max(val.max(initial=0.0), 0.0) * 1e-10
    val, vec = val[keep][::-1], vec[:, keep][:, ::-1]
    if vec.size:
        vec = vec * np.sign(vec[np.abs(vec).argmax(0), np.arange(vec.shape[1])])
    return val, vec


#: While blocks and chunks of them are run: no shuffle files beyond a write, and of rows this
#: large fewer in one Arrow batch.
LEAN = {SHUFFLE_CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


@contextmanager
def _lean(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in LEAN}
    try:
        for k, v in LEAN.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back; the shuffle files of the write go as soon as it
    has ended, as nothing reads them again."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with _lean(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same_text(x: str, y: str):
    return F.col(f"{x}.side").eqNullSafe(F.col(f"{y}.side")) & F.col(f"{x}.id").eqNullSafe(F.col(f"{y}.id"))


def text_blocks(texts: DataFrame) -> DataFrame:
    """``BLOCK_COLUMNS``: a row per block of ``texts`` (side, id, text), written
    once.  Each (side, id) is in one block, once: the terms of text ``i`` are
    ``at[start[i]:start[i + 1]]``, their counts beside them; an unknown id is 0.  Rows that share an
    id are counted together first; the others move nowhere."""
    words = tokenize(F.col("text")).alias("words")
    several = _written(texts.groupBy("side", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                       .select("side", "id"), "content-repeated")
    if several.isEmpty():
        return _written(texts.select("side", "id", words).mapInArrow(_blocked(0), BLOCK_COLUMNS), "content-blocks")
    t, s = texts.alias("t"), several.alias("s")
    alone = t.join(s, _same_text("t", "s"), "left_anti").select("side", "id", words)
    shared = t.join(s, _same_text("t", "s"), "left_semi")
    counted = (shared.select("side", "id", F.explode(tokenize(F.col("text"))).alias("term"))
               .groupBy("side", "id", "term").agg(F.count(F.lit(1)).cast("int").alias("tf"))
               .groupBy("side", "id").agg(F.collect_list(F.struct("term", "tf")).alias("c")).alias("c"))
    together = (s.join(counted, _same_text("s", "c"), "left")
                .select("s.side", "s.id", F.coalesce(F.col("c.c.term"), F.array().cast("array<string>")).alias("words"),
                        F.coalesce(F.col("c.c.tf"), F.array().cast("array<int>")).alias("times")))
    return _written(alone.mapInArrow(_blocked(0), BLOCK_COLUMNS)
                    .unionByName(together.mapInArrow(_blocked(1), BLOCK_COLUMNS)), "content-blocks")


def _blocked(kind: int):
    """Arrow batches of (side, id, words[, times]) as rows of ``BLOCK_COLUMNS``."""
    def block(rows: pa.Table, number: int) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        words = rows["words"].combine_chunks() if rows["words"].num_chunks != 1 else rows["words"].chunk(0)
        coded = pc.dictionary_encode(words.flatten())
        code, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        held = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(held)), held)
        width = max(len(terms), 1)
        if "times" in rows.column_names:
            times = pa.concat_arrays([c.flatten() for c in rows["times"].chunks]).to_numpy(zero_copy_only=False)
            order = np.argsort(text * width + code, kind="stable")
            entry, tf = (text * width + code)[order], times[order]
        else:
            entry, tf = np.unique(text * width + code, return_counts=True)
        start = np.concatenate([[0], np.cumsum(np.bincount(entry // width, minlength=len(held)))])
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(rows["side"].to_pylist(), pa.string()), one(pc.fill_null(rows["id"], 0).to_pylist(), pa.int64()),
             one(pc.is_valid(rows["id"]).to_pylist(), pa.bool_()), one(start, pa.int32()), one(entry % width, pa.int32()), one(tf, pa.int32()),
             pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms.cast(pa.string()))],
            ["block", "side", "id", "known", "start", "at", "tf", "term"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held, tokens = [], 0  # each text counts as PER_TEXT tokens more
        for batch in batches:
            size = pc.list_value_length(batch.column(batch.schema.get_field_index("words"))).to_numpy(zero_copy_only=False) + PER_TEXT
            cuts = np.searchsorted(np.cumsum(size) // BLOCK, np.arange(1, int(size.sum()) // BLOCK + 1)) if len(size) else []
            for a, b in zip([0, *cuts], [*cuts, len(size)]):
                if a == b:
                    continue
                if held and tokens + size[a:b].sum() > BLOCK:
                    yield block(pa.Table.from_batches(held), number * 2 + kind)
                    held, tokens, number = [], 0, number + 1
                held.append(batch.slice(a, b - a))
                tokens += size[a:b].sum()
        if held:
            yield block(pa.Table.from_batches(held), number * 2 + kind)

    return run


def _weight(tf) -> np.ndarray:
    return 1.0 + np.log(np.asarray(tf, np.float64))


def _sums(start: np.ndarray, at: np.ndarray, l: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each range of ``start`` the sum of ``l`` times the rows ``at`` of
    ``of``, ``ENTRIES`` entries at a time."""
    out = np.zeros((len(start) - 1, of.shape[1]))
    row = np.repeat(np.arange(len(start) - 1), np.diff(start))
    for a in range(0, len(at), ENTRIES):
        some = slice(a, a + ENTRIES)
        first = np.flatnonzero(np.diff(row[some], prepend=-1))
        out[row[some][first]] += np.add.reduceat(of[at[some]] * l[some, None], first, axis=0)
    return out


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A row after another: lists as numpy arrays (of text as Arrow ones), plain values as they are."""
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns):
            v = column[i]
            if not pa.types.is_list(column.type):
                row[name] = v.as_py()
            else:
                row[name] = v.values if pa.types.is_string(column.type.value_type) else v.values.to_numpy(zero_copy_only=False)
        yield row


def _sketched(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, sketches of unit rows) of a block's texts; zeros for empty ones."""
    l, signs = _weight(row["tf"]), np.empty((len(row["h"]), SKETCH), np.int8)
    for a in range(0, len(signs), ENTRIES):
        signs[a:a + ENTRIES] = 1 - 2 * (row["h"][a:a + ENTRIES, None] >> np.arange(SKETCH) & 1)
    size = np.sqrt(_sums(row["start"], np.zeros(len(l), int), l * l, np.ones((1, 1))))[:, 0]
    y = _sums(row["start"], row["at"], l, signs)
    return size, y / np.where(size > 0, size, 1.0)[:, None]


def _packed(**arrays: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes as hold them, and other arrays, compressed."""
    cells = []
    for a in arrays.values():
        if isinstance(a, np.ndarray) and a.dtype.kind in "iu":
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        a = a if isinstance(a, pa.Array) else pa.array(a)
        cells.append(pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a))
    batch, sink = pa.RecordBatch.from_arrays(cells, list(arrays)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict:
    return next(_rows(pa.ipc.open_stream(data).read_next_batch()))


CHUNKS = "range int, phase int, block bigint, counts binary, q binary"
PARTS = "block bigint, text array<int>, e array<float>, g array<double>"


def _chunked(basis: np.ndarray, ranges: int, names: bool) -> Callable:
    """Blocks with their terms' hashes ``h`` as ``CHUNKS``: a row per block, range and phase.  ``counts`` has the
    hashes of the block's terms in the range, ascending and as differences, of each the number of its texts,
    and by term the places of the texts (in ``texts``) and counts; ``q`` the texts' rows of ``Q``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in _rows(batch)):
            size, y = _sketched(row)
            q = y @ basis / np.where(size > 0, size, 1.0)[:, None]
            h = row["h"].view(np.uint64)
            rank = np.empty(len(h), np.int64)
            by = np.lexsort((h, h % np.uint64(ranges)))  # terms by range, there by hash
            rank[by] = np.arange(len(h))
            text = np.repeat(np.arange(len(size)), np.diff(row["start"]))
            known = np.flatnonzero(np.asarray(row["known"], bool)[text])  # a text without an id fits no term
            order = known[np.argsort(rank[row["at"][known]], kind="stable")]
            at, text, tf = rank[row["at"][order]], text[order], row["tf"][order]
            met, n = np.unique(at, return_counts=True)
            where, start = (h[by[met]] % np.uint64(ranges)).astype(np.int64), _starts(n)
            edges = np.searchsorted(where, np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(edges)):
                of, some = slice(edges[r], edges[r + 1]), slice(start[edges[r]], start[edges[r + 1]])
                texts, place = np.unique(text[some], return_inverse=True)
                held = h[by[met[of]]]
                counts = dict(h=np.diff(held, prepend=np.uint64(0)), n=n[of], text=place, tf=tf[some], texts=texts)
                named = {"term": row["term"].take(pa.array(by[met[of]]))} if names else {}
                for phase, qs in ((0, _packed(q=q[texts].astype(np.float32).ravel())), (1, None))[:1 if names else 2]:
                    yield pa.RecordBatch.from_pydict(
                        {"range": pa.array([r], pa.int32()), "phase": pa.array([phase], pa.int32()), "block": pa.array([row["block"]], pa.int64()),
                         "counts": pa.array([_packed(**counts, **named)], pa.binary()), "q": pa.array([qs], pa.binary())})

    return run


class _Range:
    """Sums over the terms of one range: ``w[slot]`` a term's row of ``B'``."""

    def __init__(self, rank: int, n: int) -> None:
        self.n, self.known, self.slot = n, np.empty(0, np.uint64), np.empty(0, np.int64)
        # Memory is taken as rows are met.
        self.w, self.df, self.names = np.zeros((RANGE + RANGE // 8, rank)), np.zeros(RANGE + RANGE // 8), []

    def slots(self, h: np.ndarray, term: pa.Array | None = None) -> np.ndarray:
        """The places of terms of ascending hashes; new ones get the next."""
        new = np.ones(len(h), bool)
        if len(self.known):
            new = self.known[np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)] != h
        if new.any():
            held, more = len(self.known), int(new.sum())
            self.known, self.slot = np.concatenate([self.known, h[new]]), np.concatenate([self.slot, np.arange(held, held + more)])
            order = np.argsort(self.known, kind="stable")
            self.known, self.slot = self.known[order], self.slot[order]
            if len(self.w) < held + more:
                room = max(held + more, len(self.w) * 5 // 4) - len(self.w)
                self.w, self.df = np.concatenate([self.w, np.zeros((room, self.w.shape[1]))]), np.concatenate([self.df, np.zeros(room)])
            if term is not None:
                self.names.append(term.filter(pa.array(new)))
        return self.slot[np.searchsorted(self.known, h)]

    def add(self, c: dict, q: np.ndarray) -> None:
        at = self.slots(np.cumsum(c["h"], dtype=np.uint64), c.get("term"))
        self.w[at] += _sums(_starts(c["n"]), c["text"], _weight(c["tf"]), q.reshape(-1, self.w.shape[1]))
        self.df[at] += c["n"]

    def weighted(self) -> np.ndarray:
        """All counted: the sums become the terms' rows of ``B'``, times their idf, which is returned."""
        self.w, self.df = self.w[:len(self.known)], self.df[:len(self.known)]
        idf = np.log((1 + self.n) / (1 + self.df)) + 1.0
        self.w *= idf[:, None]
        return idf

    def part(self, c: dict) -> np.ndarray:
        """Of each text of a block the sum of its terms' rows."""
        order = np.argsort(c["text"], kind="stable")
        at = np.repeat(np.arange(len(c["n"])), c["n"])[order]
        return _sums(_starts(np.bincount(c["text"], minlength=len(c["texts"]))), at, _weight(c["tf"])[order],
                     self.w[self.slots(np.cumsum(c["h"], dtype=np.uint64))])


def _ranges(blocks: DataFrame, names: bool) -> tuple[DataFrame, int] | None:
    """(rows, rank) of ``X' Q``, None where no text has a term.  With ``names`` the rows are (term, idf, w).  Else they are
    ``PARTS``: of a block's texts the sums over one range, and for each range, with block -1, its part of the Gram matrix."""
    hashed = blocks.withColumn("h", F.transform("term", lambda t: F.xxhash64(t)))

    def sketch_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((SKETCH, SKETCH))
        for row in (r for batch in batches for r in _rows(batch)):
            _, y = _sketched(row)
            g += y.T @ y
        yield pa.RecordBatch.from_pydict({"g": pa.array([g.ravel()], pa.list_(pa.float64()))})

    with _lean(blocks.sparkSession):
        total = summed(hashed.select("start", "at", "tf", "h").mapInArrow(sketch_gram, "g array<double>"), "g")
    val, vec = spectrum(total.reshape(SKETCH, SKETCH) if len(total) else np.zeros((SKETCH, SKETCH)))
    basis, rank = vec / np.sqrt(val), len(val)
    if not rank:
        return None
    # Texts that have a term, entries, and about how many terms.
    n, entries = blocks.agg(F.sum(F.size(F.array_distinct("start")) - 1), F.sum(F.size("at").cast("bigint"))).first()
    terms = blocks.select(F.explode("term").alias("term")).agg(F.approx_count_distinct("term", 0.02)).first()[0]
    ranges = max(1, -(-terms // RANGE), -(-entries // SHARE))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, of, idf = None, None, None
        for row in (r for batch in batches for r in _rows(batch)):
            if row["range"] != at:
                if names and of is not None:
                    yield from named(of)
                at, of, idf = row["range"], _Range(rank, n), None
            c = _unpacked(row["counts"])
            if not row["phase"]:
                of.add(c, _unpacked(row["q"])["q"])
                continue
            if idf is None:
                idf = of.weighted()
                yield parts(-1, [], [], of.w.T @ of.w)
                of.w *= idf[:, None]
            yield parts(row["block"], c["texts"], of.part(c).astype(np.float32).ravel(), None)
        if names and of is not None:
            yield from named(of)

    def parts(block: int, text, e, g: np.ndarray | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([text], pa.list_(pa.int32())), pa.array([e], pa.list_(pa.float32())),
             pa.array([None if g is None else g.ravel()], pa.list_(pa.float64()))], ["block", "text", "e", "g"])

    def named(of: _Range) -> Iterator[pa.RecordBatch]:
        idf, term = of.weighted(), pa.concat_arrays(of.names)
        for a in range(0, len(idf), 10_000):
            w = of.w[a:a + 10_000]
            yield pa.RecordBatch.from_pydict({"term": term[a:a + 10_000], "idf": pa.array(idf[a:a + 10_000]),
                                              "w": pa.ListArray.from_arrays(np.arange(0, w.size + 1, rank, dtype=np.int32), pa.array(w.ravel()))})

    chunks = hashed.select("block", "known", "start", "at", "tf", "h", *["term"] * names).mapInArrow(_chunked(basis, ranges, names), CHUNKS)
    return chunks.repartition(ranges, "range").sortWithinPartitions("range", "phase").mapInArrow(
        counted, "term string, idf double, w array<double>" if names else PARTS), rank


def _turn(g: np.ndarray, dim: int) -> np.ndarray:
    """What turns rows of ``B'`` of Gram matrix ``g`` into projections."""
    val, vec = spectrum(g)
    turn = np.zeros((len(g), dim))
    k = min(dim, len(val))
    turn[:, :k] = vec[:, :k] / np.sqrt(val[:k])
    return turn


def _fit(blocks: DataFrame, dim: int) -> DataFrame:
    found = _ranges(blocks, names=True)
    if found is None:
        return blocks.select(F.explode("term").alias("term"), F.array().cast("array<double>").alias("v")).limit(0)
    terms, rank = _written(found[0], "content-range"), found[1]
    turn = _turn(gram(terms, "w", rank), dim)

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["w"].to_numpy()) @ turn * pdf["idf"].to_numpy()[:, None]
                yield pdf[["term"]].assign(v=list(v))

    return terms.mapInPandas(turned, "term string, v array<double>")


def fit_terms(texts: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """(term, v): the fitted projection, read off the term table that is written
    once as Parquet in the shared folder.  ``texts``: (side, id, text).  A corpus
    of lower rank than ``dim`` leaves the last numbers of every vector 0."""
    return _fit(text_blocks(texts), dim)


def _projected(blocks: DataFrame, terms: DataFrame, dim: int) -> DataFrame:
    def run(block: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        row = next(block.itertuples())
        start, at, l = np.asarray(row.start, np.int64), np.asarray(row.at, np.int64), _weight(row.tf)
        v = np.zeros((max(int(row.terms), 1), dim))
        if len(vectors):
            v[vectors["k"].to_numpy()] = np.stack(vectors["v"].to_numpy())
        e = _sums(start, at, l, v)
        known = np.asarray(row.known, bool)
        e[~known] = 0.0
        size = np.sqrt((e * e).sum(1))
        e = (e / np.where(size > 0, size, 1.0)[:, None]).astype(np.float32)
        return pd.DataFrame({"side": list(row.side), "id": pd.arrays.IntegerArray(np.array(row.id, np.int64), ~known), "embedding": list(e)})

    asked = (blocks.select("block", F.posexplode("term").alias("k", "term")).join(terms, "term")
             .select("block", "k", "v"))
    return (blocks.select(F.col("block").alias("of"), "side", "id", "known", "start", "at", "tf", F.size("term").alias("terms")).groupBy("of")
            .cogroup(asked.groupBy("block")).applyInPandas(run, "side string, id bigint, embedding array<float>"))


def project(texts: DataFrame, terms: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """(side, id, embedding) for each (side, id) of ``texts``: the weighted sum of
    its terms' vectors at unit length; a text without a known term is all zeros."""
    return _projected(text_blocks(texts), terms, dim)


def content_embeddings(user_text: DataFrame, post_text: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """(side, id, embedding) of both sides in one space, one row per id.
    ``user_text``: (uid, text); ``post_text``: (po_id, text).  Nulls are empty
    texts; several texts of one id count as one."""
    texts = user_text.select(F.lit("user").alias("side"), F.col("uid").alias("id"), "text").unionByName(
        post_text.select(F.lit("post").alias("side"), F.col("po_id").alias("id"), "text"))
    blocks = text_blocks(texts)
    found = _ranges(blocks, names=False)
    if found is None:
        parts, turn = blocks.sparkSession.createDataFrame([], PARTS), np.zeros((0, dim))
    else:
        parts = _written(found[0], "content-parts")
        turn = _turn(summed(parts.filter("block < 0"), "g").reshape(found[1], found[1]), dim)

    def joined(block: pa.Table, of: pa.Table) -> pa.Table:
        side, known = block["side"].chunk(0)[0].values, block["known"].chunk(0)[0].values
        e = np.zeros((len(side), len(turn)))
        for row in (r for batch in of.to_batches() for r in _rows(batch)):
            e[row["text"]] += row["e"].reshape(len(row["text"]), -1)
        e = e @ turn
        size = np.sqrt((e * e).sum(1))
        e = (e / np.where(size > 0, size, 1.0)[:, None]).astype(np.float32)
        id_ = pc.if_else(known, block["id"].chunk(0)[0].values, pa.scalar(None, pa.int64()))
        vectors = pa.ListArray.from_arrays(np.arange(0, e.size + 1, dim, dtype=np.int32), pa.array(e.ravel()))
        return pa.table([side, id_, vectors], ["side", "id", "embedding"])

    return (blocks.select("block", "side", "id", "known").groupBy("block").cogroup(parts.filter("block >= 0").drop("g").groupBy("block"))
            .applyInArrow(joined, "side string, id bigint, embedding array<float>"))
