"""How the sources of a language differ in the words they use, by a frequent-pattern tree over term rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: Bytes that are no part of a term become spaces; A to Z are lower-cased; bytes of other characters stay.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Bytes of a text whose words a task lists at once, and counts that it holds before it hands them on.
PIECE_BYTES, MOST_HELD = 1 << 20, 500_000
#: Numbers of term rows that one tree of a task holds at most (a longer row stands alone).
TREE_CELLS = 1_000_000
ONE = 1_000_000_000
#: Items of a path that decide its range.
RANGE_ITEMS = 6


def term_pieces(text: bytes, most: int) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about so many bytes; no term is cut."""
    plain, at = text.translate(_LETTERS), 0
    while at < len(plain):
        upto = len(plain) if len(plain) - at <= most else plain.find(b" ", at + most)
        upto = len(plain) if upto < 0 else upto
        yield plain[at:upto].split()
        at = upto


def _handed_on(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = [b"", *counts]  # the empty term says that the group occurs
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * len(terms), pa.string()),
                "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array([0, *counts.values()], pa.int64()),
                "docs": pa.array([0, *(docs[t] for t in counts)], pa.int64()),
            }
        )


def _count_terms(piece_bytes: int, most_held: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for some in slices(batch, "text", piece_bytes, 4096):
                for lang, source, text in zip(*(listed(some.column(c)) for c in ("lang", "source", "text")), strict=True):
                    counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    seen: set[bytes] = set()
                    for terms in term_pieces(text, piece_bytes):
                        counts.update(terms)
                        seen.update(terms)
                    docs.update(seen)
                if sum(len(c) for c, _ in held.values()) > most_held:
                    yield from _handed_on(held)
                    held = {}
        yield from _handed_on(held)

    return run


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term); every group has a row of the empty term.

    Tasks count before anything is shuffled, so a hot source or word sends a row for each task and term.
    """
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    slim = bounded(docs).select(empty[0].alias("lang"), empty[1].alias("source"), empty[2].cast("binary").alias("text"))
    counted = slim.mapInArrow(_count_terms(PIECE_BYTES, MOST_HELD), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def chance(n: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact for any long."""
    return F.expr(f"1L + (CAST({ONE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))) div CAST({total} + 2 * {terms} AS DECIMAL(20,0))")


def apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); numbers up to 10^9 + 1 keep the square in a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def tree_sums(paths: list[np.ndarray], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the frequent-pattern tree of some term rows adds to the divergences of their sources.

    paths: for each row an ascending array of (source, p, z): the source's number, the chance of the row's count in it
    and of a count of zero. times: how many terms have the row. Rows are in lexicographic order, so rows that share a
    path are neighbours, and a node is a run of them. A node counts once for each of its ancestors, times the terms
    below it. Returns (a, b, value) for pairs of sources a < b that have a common term: the sum over those of f(pa, pb)
    - f(pa, zb) - f(za, pb) + f(za, zb); and (source, p, terms) for the nodes themselves.
    """
    length = np.array([len(x) for x in paths], np.int64)
    cells = np.full((len(paths), int(length.max(initial=0)), 3), -1, np.int64)
    for row, path in zip(cells, paths, strict=True):
        row[: len(path)] = path
    shared = np.zeros(len(paths), np.int64)  # how many items a row has in common with the row before
    same = (cells[1:] == cells[:-1]).all(2)
    shared[1:] = np.where(same.all(1), same.shape[1], np.argmin(same, axis=1)) if same.shape[1] else 0
    pairs, nodes = [], []
    for depth in range(cells.shape[1]):
        rows = np.flatnonzero(length > depth)
        starts = np.flatnonzero(shared[rows] <= depth)
        below, first = np.add.reduceat(times[rows], starts), rows[starts]
        source, p, z = cells[first, depth].T
        nodes.append(np.stack([source, p, below], 1))
        for above in range(depth):
            other, q, y = cells[first, above].T
            value = below * (_apart(p, q) - _apart(p, y) - _apart(z, q) + _apart(z, y))
            pairs.append(np.stack([other, source, value], 1))
    return _summed(pairs), _summed(nodes)


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of (key, key, value), values of equal keys added."""
    whole = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
    keys, place = np.unique(whole[:, :2], axis=0, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place.ravel(), whole[:, 2])
    return np.column_stack([keys, total])


def _grow_trees(most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            items = batch.column("path")
            flat = items.flatten()
            cells = np.column_stack([flat.field(c).to_numpy().astype(np.int64) for c in ("k", "p", "z")])
            at = items.offsets.to_numpy().astype(np.int64)
            at -= at[0]
            langs, times = listed(batch.column("lang")), batch.column("terms").to_numpy()
            begin = 0
            while begin < len(langs):
                end, widest = begin, 0
                while end < len(langs) and langs[end] == langs[begin]:
                    widest = max(widest, int(at[end + 1] - at[end]))
                    if end > begin and widest * (end + 1 - begin) > most:
                        break
                    end += 1
                pairs, nodes = tree_sums([cells[at[i] : at[i + 1]] for i in range(begin, end)], times[begin:end])
                for kind, sums in (("pair", pairs), ("node", nodes)):
                    if len(sums):
                        yield pa.record_batch(
                            {
                                "kind": pa.array([kind] * len(sums)),
                                "lang": pa.array([langs[begin]] * len(sums), pa.string()),
                                **{c: pa.array(sums[:, i]) for i, c in enumerate("abv")},
                            }
                        )
                begin = end

    return run


def _pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value for the pairs of a language's groups with numbers a < b."""
    item = F.struct(F.col("k"), F.col("p"), F.col("z"))
    rows = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(item)).alias("path"))
    # equal rows of different terms are one path of the tree; ranges of paths meet where they share what they begin with
    paths = written(rows.groupBy("lang", "path").agg(F.count("*").alias("terms")), "divergence-paths")
    # ranges are told apart by how paths begin, so what Spark samples for them is small
    start = F.transform(F.slice("path", 1, RANGE_ITEMS), lambda x: x["k"] * (1 << 32) + x["p"])
    ranged = paths.repartitionByRange("lang", start).sortWithinPartitions("lang", "path")
    sums = written(ranged.mapInArrow(_grow_trees(TREE_CELLS), "kind string, lang string, a long, b long, v long"), "divergence-sums")
    one = groups.select("lang", F.col("k").alias("a"), F.col("z").alias("za"), "vocabulary")
    two = groups.select("lang", F.col("k").alias("b"), F.col("z").alias("zb"))
    both = one.join(two, "lang").filter("a <> b")
    nodes = sums.filter("kind = 'node'").groupBy("lang", "a", F.col("b").alias("p")).agg(F.sum("v").alias("terms"))
    # a group's terms against zero counts of each other group; pairs take both sides
    alone = nodes.join(both, ["lang", "a"]).withColumn("v", F.col("terms") * (apart("p", "zb") - apart("za", "zb")))
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    none = both.filter("a < b").withColumn("v", F.when(F.col("vocabulary") > 0, F.col("vocabulary") * apart("za", "zb")).otherwise(0))
    parts = none.select("lang", "a", "b", "v").unionByName(alone.select("lang", least, most, "v"))
    parts = parts.unionByName(sums.filter("kind = 'pair'").select("lang", "a", "b", "v"))
    return parts.groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))


def source_divergence(
    docs: DataFrame, min_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """For each group (lang, source): its divergence from every other source of the language, and the top terms that it uses more.

    Terms are runs of ASCII letters and other non-ASCII characters, A to Z lower-cased; a language keeps those in
    min_docs or more of its documents. A group gives a term the chance p = 1 + floor(10^9 (n + 2) / (N + 2 V)). Part
    "pair" has the sum of f(p, q) = floor((p - q)^2 / (p + q)) over the language's terms; part "term" has f of the terms
    whose chance in the group is above the language's, ranks to top. A term row lists the nonzero counts of a term in
    the order of the sources' names; rows share paths of a frequent-pattern tree that is grown over ranges of paths, and
    a node adds a pair's correction once for each ancestor, times the terms below it. A path that a range's border cuts
    is two nodes, whose sums add up.

    Null text, lang and source are ''. Repeated rows count as often as they stand there. A language without kept terms
    has values 0. An empty table gives no rows; other columns are not read.
    Returns lang, source, part, item, value, rank.
    """
    counts = written(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    term = Window.partitionBy("lang", "term")
    kept = counts.filter("term <> ''").withColumn("all_docs", F.sum("docs").over(term)).withColumn("all_n", F.sum("n").over(term))
    kept = kept.withColumn("first", F.col("source") == F.min("source").over(term)).filter(F.col("all_docs") >= min_docs)
    kept = written(kept.select("lang", "source", "term", "n", "all_n", "first"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("vocabulary"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "vocabulary", "lang_total"])
    groups = groups.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
    zero = F.when(F.col("vocabulary") > 0, chance("0", "total", "vocabulary"))
    groups = written(groups.withColumn("z", zero), "divergence-groups")

    kept = kept.join(groups, ["lang", "source"]).withColumn("p", chance("n", "total", "vocabulary"))
    above = kept.withColumn("q", chance("all_n", "lang_total", "vocabulary")).filter("p > q")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))

    values = written(_pair_values(kept, groups), "divergence-pairs")
    names = groups.select("lang", "k", "source")
    first, second = names.toDF("lang", "a", "source_a"), names.toDF("lang", "b", "source_b")
    named = values.join(first, ["lang", "a"]).join(second, ["lang", "b"])
    ways = [named.select("lang", F.col(x).alias("source"), F.lit("pair").alias("part"), F.col(y).alias("item"), "value") for x, y in (("source_a", "source_b"), ("source_b", "source_a"))]
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = ways[0].unionByName(ways[1]).withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
