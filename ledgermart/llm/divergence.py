"""Divergence between the sources of a language, over a quadtree of the group-term counts.

A language's sources (rows) and kept terms (columns) span a count matrix that is mostly
zero. The columns are cut into strips and the rows into bands; each strip and pair of
bands is a unit of work, with a K-squared quadtree (K = 2) of the cells that aren't zero.
The trees of both bands are traversed together: a quadrant that is empty in both is left
out, and where a leaf isn't, the terms of the divergence are computed for all pairs of
its groups at once. What was left out is uniform: in such a column both groups have the
probability of a zero count, so one product prices all of them.

All arithmetic is exact. A term's probability, in units of 1 / SCALE, is
``1 + floor(SCALE * (count + 2) / (N + 2 V))``, and two probabilities p, q diverge by
``floor((p - q)^2 / (p + q))``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermart.llm.common import utf8, written
from ledgermart.operators.sizing import broadcast_if_small

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Columns of a strip (about) and rows of a band: a unit's matrix has at most so many cells.
STRIP_TERMS = 4096
BAND_GROUPS = 128
#: Rows and columns of a leaf.
LEAF = 16
#: Cells, and documents, that a map task counts before it sends them on.
HELD_CELLS = 500_000
HELD_DOCS = 1 << 20

#: Letters in lower case, bytes above ASCII as they are, all else a blank.
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, repeats included: runs of ASCII letters and of what lies above ASCII."""
    return utf8(text).translate(_LETTERS).split(b" ")


#: A cell's documents are counted in steps of this, above its occurrences.
_ONE_DOC = 1 << 40


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the texts seen, summed as far as they fit; term null: the group itself."""
    counts: dict[tuple[str, str], dict[bytes, int]] = {}
    held = held_docs = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), cells in counts.items():
            both = np.array([0, *cells.values()], dtype=np.int64)
            names = pa.array([None, *cells], pa.binary()).cast(pa.string())
            own = [pa.repeat(pa.scalar(x, pa.string()), len(names)) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*own, names, pa.array(both % _ONE_DOC), pa.array(both // _ONE_DOC)], names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            cells = counts.setdefault((lang.as_py(), source.as_py()), {})
            own = Counter(terms(text.as_py()))
            own.pop(b"", None)
            held -= len(cells)
            for term, n in own.items():
                cells[term] = cells.get(term, 0) + n + _ONE_DOC
            held, held_docs = held + len(cells), held_docs + 1
            if held > HELD_CELLS or held_docs == HELD_DOCS:
                yield from flush()
                held = held_docs = 0
    yield from flush()


def probability(n: Column, total: Column, kept: Column) -> Column:
    """In units of 1 / SCALE, exact."""
    up = (n.cast("decimal(20,0)") + F.lit(2).cast("decimal(20,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", up, F.nullif(total.cast("decimal(20,0)") + kept.cast("decimal(20,0)") * 2, F.lit(0)))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), F.nullif(p + q, F.lit(0)))


def quadtree(rows: np.ndarray, cols: np.ndarray, levels: int) -> list[set[int]]:
    """For each level, root first, the codes of the quadrants that hold a cell; leaves are LEAF x LEAF cells.

    A code interleaves the bits of the row and the column of the quadrant.
    """
    r, c = rows // LEAF, cols // LEAF
    code = np.zeros(len(r), dtype=np.int64)
    for bit in range(levels):
        code |= ((r >> bit) & 1) << (2 * bit + 1) | ((c >> bit) & 1) << (2 * bit)
    return [set(np.unique(code >> (2 * (levels - level))).tolist()) for level in range(levels + 1)]


class _Band:
    """The groups of a band, their probability for a zero count, and their cells with the quadtree."""

    def __init__(self, group: np.ndarray, p0: np.ndarray, cell_group: np.ndarray, cell_term: np.ndarray, cell_p: np.ndarray, levels: int):
        order = np.argsort(group)
        self.group, self.p0 = group[order], p0[order]
        self.row = np.searchsorted(self.group, cell_group)
        self.term, self.p = cell_term, cell_p
        self.levels = quadtree(self.row, self.term, levels)
        leaf = (self.row // LEAF << 32) | (self.term // LEAF)
        self.by_leaf = np.argsort(leaf, kind="stable")
        self.leaf = leaf[self.by_leaf]

    def leaf_matrix(self, r: int, c: int) -> np.ndarray:
        """Probabilities of the leaf's groups and columns."""
        first = r * LEAF
        n = min(LEAF, len(self.group) - first)
        out = np.repeat(self.p0[first : first + n, None], LEAF, axis=1)
        at = self.by_leaf[slice(*np.searchsorted(self.leaf, [(r << 32) | c, ((r << 32) | c) + 1]))]
        out[self.row[at] - first, self.term[at] - c * LEAF] = self.p[at]
        return out


def _joint(a: _Band, b: _Band, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of groups: the divergence summed over the leaves visited, and the number of their columns."""
    sums = np.zeros((len(a.group), len(b.group)), dtype=np.int64)
    seen = np.zeros_like(sums)
    alike = a is b  # then one half will do
    children = [(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]
    stack = [(0, 0, 0, 0, 0, 0)]  # level, rows of a, of b, columns, and the codes of both quadrants
    while stack:
        level, ra, rb, c, code_a, code_b = stack.pop()
        full_a, full_b = code_a in a.levels[level], code_b in b.levels[level]
        if not full_a and not full_b:
            continue  # uniform: priced with all other columns left out
        side = LEAF << (levels - level)
        if ra * side >= len(a.group) or rb * side >= len(b.group) or alike and rb < ra:
            continue
        if level < levels:
            stack += [(level + 1, 2 * ra + x, 2 * rb + y, 2 * c + z, code_a << 2 | x << 1 | z, code_b << 2 | y << 1 | z) for x, y, z in children]
            continue
        p, q = a.leaf_matrix(ra, c), b.leaf_matrix(rb, c)
        diff = p[:, None, :] - q[None, :, :]
        at = (slice(ra * LEAF, ra * LEAF + len(p)), slice(rb * LEAF, rb * LEAF + len(q)))
        sums[at] += (diff * diff // (p[:, None, :] + q[None, :, :])).sum(axis=2)
        seen[at] += LEAF
    return sums, seen


def _unit(key: tuple, cells: pa.Table) -> pa.Table:
    """Partial sums of a strip and two bands; rows without a term name the bands' groups.

    Columns are numbered by falling count in the language, which brings the zero cells together.
    """
    band_a, band_b = key[2].as_py(), key[3].as_py()
    cells = cells.append_column("falling", pc.negate(cells.column("lang_n")))
    cells = cells.take(pc.sort_indices(cells, [("falling", "ascending"), ("term", "ascending")]))
    band, group, p = (cells.column(n).to_numpy() for n in ("band", "group", "p"))
    named = cells.column("term").combine_chunks()
    column = named.dictionary_encode().indices.fill_null(-1).to_numpy()  # numbered as they first occur

    def made(which: int) -> _Band:
        own = band == which
        head, cell = own & (column < 0), own & (column >= 0)
        return _Band(group[head], p[head], group[cell], column[cell].astype(np.int64), p[cell], levels)

    widest = max(int(column.max(initial=0)) + 1, int((column < 0).sum()))
    levels = (-(-widest // LEAF) - 1).bit_length()
    a = made(band_a)
    b = a if band_a == band_b else made(band_b)
    sums, seen = _joint(a, b, levels)
    i, j = np.nonzero(seen)
    once = a.group[i] < b.group[j]
    i, j = i[once], j[once]
    lang = pa.array([key[0].as_py()] * len(i), pa.string())
    return pa.table({"lang": lang, "a": a.group[i], "b": b.group[j], "value": sums[i, j], "seen": seen[i, j]})


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    strip_terms: int = STRIP_TERMS,
    band_groups: int = BAND_GROUPS,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language lies from the others.

    Part ``pair`` has a row for each other source of the language, the divergence summed
    over all kept terms (0 if none is kept). Part ``term`` has the ``top`` terms that
    occur in the source and are likelier there than in the whole language. Rank runs from 1
    for each source and part by falling value, ties by the item's UTF-8. A term is kept
    in a language if at least ``min_docs`` of its documents hold it. Null text, lang and
    source are empty; empty texts still make their group; repeated rows count each.
    An empty table gives no rows. Other columns of ``docs``, whatever their names, aren't read.
    """
    empty = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    read = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    counted = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # map tasks have summed; one shuffle brings the sources of a term together, for the sums below
    cells = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    cells = cells.withColumns({
        "lang_docs": F.sum("docs").over(of_term),
        "lang_n": F.sum("n").over(of_term),
        "first": F.row_number().over(of_term.orderBy("source")) == 1,
    })
    cells = cells.filter((F.col("lang_docs") >= min_docs) | F.col("term").isNull()).select("lang", "source", "term", "n", "lang_n", "first")
    cells = written(cells, "cells")

    named = F.col("term").isNotNull()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(named & F.col("first")).alias("kept_here"))
    totals = written(totals, "totals")  # a row for each group
    size = totals.groupBy("lang").agg(F.sum("kept_here").alias("kept"), F.sum("total").alias("lang_total"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    groups = totals.drop("kept_here").join(size, "lang").withColumn("group", number)
    p0 = F.coalesce(probability(F.lit(0), F.col("total"), F.col("kept")), F.lit(0)).cast("long")  # 0: nothing is kept
    groups = groups.withColumns({"band": F.floor(F.col("group") / band_groups).cast("long"), "strips": F.ceil(F.col("kept") / strip_terms).cast("long"), "p0": p0})
    groups = written(groups, "groups")

    full = cells.filter(named).join(broadcast_if_small(groups), ["lang", "source"])
    full = full.withColumn("p", probability(F.col("n"), F.col("total"), F.col("kept"))).withColumn("strip", F.pmod(F.xxhash64("term"), F.col("strips")))
    return _pairs(full, groups).unionByName(_top_terms(full, top))


def _top_terms(full: DataFrame, top: int) -> DataFrame:
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    likelier = full.withColumn("q", q).filter("n > 0 and p > q").withColumn("value", divergence(F.col("p"), F.col("q")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    ranked = likelier.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(full: DataFrame, groups: DataFrame) -> DataFrame:
    """A unit takes the cells of its two bands in its strip, and a row for each of their groups."""
    bands = broadcast_if_small(groups.groupBy("lang").agg((F.max("band") + 1).alias("bands")))  # a row for each language
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))
    strips = F.explode(F.when(F.col("strips") > 0, F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)))
    heads = groups.select("lang", strips.alias("strip"), "band", "group", F.col("p0").alias("p"))
    heads = heads.withColumns({"term": F.lit(None).cast("string"), "lang_n": F.lit(0).cast("long")})
    dealt = (
        full.select("lang", "strip", "band", "group", "term", "lang_n", "p")
        .unionByName(heads)
        .join(bands, "lang")
        .withColumn("other", others)
        .withColumn("band_a", F.least("band", "other"))
        .withColumn("band_b", F.greatest("band", "other"))
        .drop("bands", "other")
    )
    parts = dealt.groupBy("lang", "strip", "band_a", "band_b").applyInArrow(_unit, "lang string, a long, b long, value long, seen long")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"))

    # a row for each ordered pair is what the result has; they are dealt by band
    own = groups.join(bands, "lang").select("lang", F.col("group").alias("a"), F.col("source").alias("a_source"), F.col("p0").alias("a_p0"), "kept", others.alias("band"))
    named = own.join(groups.select("lang", "band", F.col("group").alias("b"), F.col("source").alias("b_source"), F.col("p0").alias("b_p0")), ["lang", "band"])
    uniform = F.coalesce(divergence(F.col("a_p0"), F.col("b_p0")), F.lit(0)) * (F.col("kept") - F.coalesce("seen", F.lit(0)))
    priced = named.filter("a <> b").join(both, ["lang", "a", "b"], "left").withColumn("value", (F.coalesce("value", F.lit(0)) + uniform).cast("long"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.desc("value"), "b_source"))
    return priced.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), "value", rank.alias("rank"))
