"""Near-duplicate documents by HyperMinHash: compressed minima, banding, corrected estimates and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: Minima of a document, in BANDS bands of ROWS: two sets of similarity 0.8 share no band once in 200,000 times.
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
#: The least similarity, in percent, that the bands are made for.
LEAST = 80
#: Bits kept after the leading one of a minimum.
MANTISSA = 10
#: Pairs whose estimate is further below the threshold than this (over four standard errors) are not compared in full.
SLACK = 0.12
#: Members of a band, and shingles of theirs, in one block; a task compares two blocks.
BLOCK, BLOCK_SHINGLES = 512, 400_000
#: What a task holds as Python values at once.
AT_ONCE, BYTES_AT_ONCE = 256, 1 << 20
#: A task remembers the hashes of at most this many words, then starts afresh.
REMEMBERED = 300_000

_RANDOM = np.random.default_rng(20_24)
_FACTORS = _RANDOM.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, n_words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of n_words words; fewer words count as one run, none as no run.

    known: hashes of words seen before, which may be shared by many texts.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        code = known.get(w)
        if code is None:
            code = known[w] = xxhash.xxh64_intdigest(w)
        codes[i] = code
    span = min(n_words, len(words))
    runs = len(words) - span + 1
    hashes = np.full(runs, span, np.uint64)
    for k in range(span):
        hashes = _mixed(hashes * _STEP + codes[k : k + runs])
    return np.unique(hashes)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """REGISTERS 16-bit values for each non-empty set: leading zeros of the least hash, and the bits after its first one."""
    joined = np.concatenate(sets)
    starts = np.zeros(len(sets), np.int64)
    np.cumsum([len(s) for s in sets[:-1]], out=starts[1:])
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(joined * _FACTORS[i] + _OFFSETS[i], starts)
    zeros = (53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    bits = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | bits).astype("<u2")


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a row of registers."""
    rows = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    keys = np.zeros((len(values), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _STEP + rows[:, :, k])
    return keys.view(np.int64)


def chance_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How likely two registers of disjoint sets of n and m elements agree: the sum over all bins of least hashes."""
    total = n + m - 1.0
    zeros = np.arange(54.0)[:, None]
    width = 2.0 ** -(zeros + 1 + MANTISSA)
    high, low = 2.0**-zeros, 2.0 ** -(zeros + 1)
    inside = np.exp(total * np.log1p(-np.minimum(low, 1 - 1e-12))) - np.exp(total * np.log1p(-np.minimum(high, 1 - 1e-12)))
    return (width * (n * m / total) * inside).sum(0)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarities from rows of registers, less what agrees by chance."""
    same = (a == b).mean(1)
    chance = chance_collisions(n.astype(np.float64), m.astype(np.float64))
    return np.maximum(0.0, (same - chance) / (1 - chance))


def _sketch(n_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known: dict[bytes, int] = {}
        for batch in batches:
            for some in slices(batch, "text", BYTES_AT_ONCE, AT_ONCE):
                if len(known) > REMEMBERED:
                    known = {}
                sets = [shingle_set(t or b"", n_words, known) for t in listed(some.column("text"))]
                full = [i for i, s in enumerate(sets) if len(s)]
                rows: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, row in zip(full, registers([sets[i] for i in full]), strict=True):
                        rows[i] = row.tobytes()
                yield pa.record_batch(
                    {
                        "id": some.column("id"),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "set_key": pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        "registers": pa.array(rows, pa.binary()),
                    }
                )

    return run


def _to_bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            values = np.frombuffer(b"".join(listed(batch.column("registers"))), "<u2").reshape(-1, REGISTERS)
            keys = band_keys(values)
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
            yield pa.record_batch(
                {"id": batch.column("id"), "bands": pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))}
            )


def _likely(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(listed(batch.column(c))), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb")
                )
                guess = estimate(a, b, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
                keep = pa.array(guess >= least)
                yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(keep)

    return run


def _confirm(n_words: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known: dict[bytes, int] = {}
        last, set_a = None, None
        for batch in batches:
            a_ids, b_ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            linked = []
            for i in range(batch.num_rows):
                if len(known) > REMEMBERED:
                    known = {}
                if last != a_ids[i]:
                    last, set_a = a_ids[i], shingle_set(batch.column("ta")[i].as_py() or b"", n_words, known)
                set_b = shingle_set(batch.column("tb")[i].as_py() or b"", n_words, known)
                both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                linked.append(100 * both >= percent * (len(set_a) + len(set_b) - both))
            yield pa.record_batch(
                {"a": pa.array(a_ids, pa.int64()), "b": pa.array(b_ids, pa.int64()), "linked": pa.array(linked, pa.bool_())}
            )

    return run


def _open_pairs(rows: pa.Table, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Of a group of band members: each member with those after it that it may be linked to and is not connected with.

    A pair counts in the first band that its members share, and where their blocks are the group's two blocks.
    """
    values = np.frombuffer(b"".join(listed(rows["registers"])), "<u2").reshape(-1, REGISTERS)
    keys = band_keys(values)
    sizes, labels = rows["n"].to_numpy(), rows["label"].to_numpy()
    blocks, nth = rows["block"].to_numpy(), rows["nth"][0].as_py()
    apart = rows["p"][0].as_py() != rows["q"][0].as_py()
    for i in range(len(values) - 1):
        j = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        if apart:
            j = j[blocks[j] != blocks[i]]
        if nth:
            j = j[~(keys[j, :nth] == keys[i, :nth]).any(1)]
        if len(j):
            guess = estimate(values[j], values[i], sizes[j], np.full(len(j), sizes[i]))
            j = j[guess >= least]
        if len(j):
            yield i, j


_MEMBER = "band long, nth int, p int, q int, block int, id long, label long, n long, registers binary"


def _marked(least: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        mark = np.zeros(rows.num_rows, bool)
        for i, j in _open_pairs(rows, least):
            mark[i] = True
            mark[j] = True
        return rows.filter(pa.array(mark))

    return run


def _linked(n_words: int, percent: int, least: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        known: dict[bytes, int] = {}
        texts = [shingle_set(t.as_py() or b"", n_words, known) for t in rows["text"]]
        ids, labels = rows["id"].to_pylist(), rows["label"].to_pylist()
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for i, others in _open_pairs(rows, least):
            for j in others.tolist():
                # one link between two components joins them
                if (labels[i], labels[j]) in found:
                    continue
                both = len(np.intersect1d(texts[i], texts[j], assume_unique=True))
                if 100 * both >= percent * (len(texts[i]) + len(texts[j]) - both):
                    found[labels[i], labels[j]] = found[labels[j], labels[i]] = (ids[i], ids[j])
        pairs = sorted(set(found.values()))
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return run


def connected(edges: DataFrame) -> DataFrame:
    """id and label for each node of edges (a, b): the least node that it can reach.

    Each round takes the least label among neighbours, then the label of the label, until no label falls. Rounds are
    written to the shared folder, so neither plans nor lost executors pile up; nothing is collected but one sum.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels")
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    last = labels.agg(total).first()[0]
    while last is not None:
        heard = both.join(labels.withColumnRenamed("id", "a"), "a").select(F.col("b").alias("id"), "label")
        least = heard.unionByName(labels).groupBy("id").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        labels = written(
            least.join(jump, "label", "left").select("id", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        now = labels.agg(total).first()[0]
        if now == last:
            break
        last = now
    return labels


def near_duplicates(
    docs: DataFrame, n_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of documents linked by the similarity of their word shingles: id_col, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words; a document's set holds its distinct runs of n_words words. Two
    documents are linked if 100 * intersection >= percent * union, equal sets always; groups are what links connect, and
    the least id of a group is its component_id and the one that is kept. Documents without words are linked with none.

    Equal sets form a class, and only a class's least id goes on. Its registers are cut into bands; classes that share a
    band are candidates. First each member of a band is compared with the band's least member, which is linear in the
    band's size however hot it is; pairs whose estimate is well below the threshold go, and the others are confirmed on
    the full sets. Then members of one band that are not connected yet are compared with each other in blocks of about
    BLOCK members and BLOCK_SHINGLES shingles, inside the task that holds the two blocks: nothing is emitted for a pair but
    a confirmed link, and no link between candidates is lost. Ids must be unique. Rows without one are linked with none,
    each is a component of its own (null) and kept. Repeated rows count as copies of one document. Extra columns are
    ignored; an empty table gives no rows. A percent under LEAST raises: there the bands would lose links.
    """
    if percent < LEAST:
        raise ValueError(f"{BANDS} bands of {ROWS} are made for a percent of {LEAST} or more, not {percent}")
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sketched = written(
        slim.mapInArrow(_sketch(n_words), "id long, n_shingles long, set_key binary, registers binary"), "sketches"
    )
    full = sketched.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = written(
        full.groupBy("set_key").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n"), F.max("registers").alias("registers")),
        "classes",
    )
    bands = written(
        classes.select(F.col("rep").alias("id"), "registers")
        .mapInArrow(_to_bands, "id long, bands array<long>")
        .select("id", F.posexplode("bands").alias("nth", "band")),
        "bands",
    )
    shared = written(
        bands.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("members")).filter("members > 1"), "shared-bands"
    )
    sides = classes.select(F.col("rep").alias("id"), "n", "registers")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b): those linked, after the estimate has sorted out the others."""
        joined = pairs.join(sides.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra")), "a").join(
            sides.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb")), "b"
        )
        likely = joined.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(percent / 100 - SLACK), "a long, b long")
        likely = written(likely, "likely-pairs")
        with_b = likely.join(slim.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        with_a = with_b.join(slim.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        found = with_a.select("a", "b", "ta", "tb").mapInArrow(_confirm(n_words, percent), "a long, b long, linked boolean")
        return written(found.filter("linked").select("a", "b").distinct(), "confirmed")

    stars = bands.join(shared, "band").filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = confirmed(stars)
    labels = connected(links)

    # what is left: members of one band in different components, neither of them the band's least
    least = percent / 100 - SLACK
    wide = bands.join(shared.filter("members > 2"), "band").filter("id <> lead")
    placed = wide.join(labels, "id", "left").select("band", "nth", "id", F.coalesce("label", "id").alias("label"))
    mixed = placed.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    placed = placed.join(mixed.select("band"), "band", "left_semi").join(sides, "id")
    placed = written(placed, "unconnected")
    wanted = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    placed = placed.join(placed.groupBy("band").agg(wanted.alias("blocks")), "band")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    names = [c.split(" ")[0] for c in _MEMBER.split(", ")]
    marked = placed.select(*names).groupBy("band", "p", "q").applyInArrow(_marked(least), _MEMBER)
    marked = written(marked, "open-pairs")
    if not marked.isEmpty():
        more = marked.join(slim.select("id", "text"), "id").select(*names, "text")
        more = more.groupBy("band", "p", "q").applyInArrow(_linked(n_words, percent, least), "a long, b long")
        labels = connected(links.unionByName(written(more.distinct(), "confirmed")))

    named = sketched.join(classes.select("set_key", "rep"), "set_key", "left").join(
        labels.withColumnRenamed("id", "rep"), "rep", "left"
    )
    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    component = F.when(linked, F.coalesce("label", "rep", "id")).otherwise(F.col("id"))
    return named.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
