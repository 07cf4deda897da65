"""How far the sources of a language differ in what they write: exact sums of differences of shares.

Each (language, source) group gives each kept term a share that depends on the group and on how often
the term occurs there, its level. So the sum of differences of two groups follows from their joint
table: how many terms have level a in the one and level b in the other. With one indicator column for
each (group, level) and one row for each term, the product of the transposed matrix and itself holds
the joint tables of all pairs of groups. It is taken in blocks: a block of terms of about the same
frequency has few levels, so its matrix is narrow; columns are cut into runs; and the cells of each
product are priced at once, as sums over blocks of terms are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import BATCH_ROWS, intermediate, stored, table

# Bytes of text whose words are counted at a time; a longer text is counted by itself.
SLICE_BYTES = 24 << 20
# Terms of a block, and those of one in which nearly every term has a level of its own.
TERMS, RARE_TERMS, MANY = 256, 128, 2**14
# Groups on either side of a product, and indicator columns of a product's side.
GROUPS, COLUMNS = 64, 1024
# Rows of three numbers and names that are sent to all tasks at most.
BROADCAST_ROWS = 100_000
SHARES = 1_000_000_000
MIN_DOCS, SMOOTHING, TOP = 30, 5, 50

# Bytes of words: ASCII letters and all of other characters. Only A-Z have another lower case.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "lang string, one int, other int, value long"
_CELLS = "lang string, one int, level long, other int, other_level long, terms long"


def _words(texts: pa.LargeStringArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of each word, and the words."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    begin, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8, size, begin) if size else np.zeros(0, np.uint8)
    bounds = offsets - begin
    word = _WORD[data]
    cut = np.zeros(size + 1, bool)
    cut[bounds] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:size]
    last[:-1] &= ~word[1:] | cut[1:size]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.flatnonzero(last) + 1 - starts)
    spans = np.concatenate([np.zeros(1, np.int64), ends]).astype(np.int64)
    chars = _LOWER[data[word]]
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(spans), pa.py_buffer(chars))
    return np.searchsorted(bounds, starts, "right") - 1, terms.dictionary_encode()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of about :data:`SLICE_BYTES` of text together, whatever the batches; one at least."""
    kinds = pa.schema([(name, pa.large_string()) for name in ("lang", "source", "text")])
    held, size = [], 0
    for batch in batches:
        wide = pa.RecordBatch.from_arrays(
            [column.cast(pa.large_string()) for column in batch.columns], schema=kinds
        )
        ends = np.cumsum(pc.binary_length(wide.column(2)).to_numpy())
        at = begin = 0
        while at < wide.num_rows:
            end = int(np.searchsorted(ends, begin + SLICE_BYTES - size, "right"))
            end = max(end, at + (not held)) if end < wide.num_rows else wide.num_rows
            if end > at:
                held.append(wide.slice(at, end - at))
                size += int(ends[end - 1]) - begin
                at, begin = end, int(ends[end - 1])
            if at < wide.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group in each slice."""
    for part in _slices(batches):
        if not part.num_rows:
            continue
        langs, sources, texts = (column.chunk(0) for column in part.columns)
        rows, words = _words(texts)
        size = max(len(words.dictionary), 1)
        in_row, n = np.unique(rows * size + words.indices.to_numpy(), return_counts=True)
        langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
        width = max(len(sources.dictionary), 1)
        group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
        keys = group[in_row // size] * size + in_row % size
        found, back, docs = np.unique(keys, return_inverse=True, return_counts=True)
        total = np.bincount(back, weights=n, minlength=len(found)).astype(np.int64)
        of_group = found // size
        columns = [
            langs.dictionary.take(pa.array(of_group // width)).cast(pa.string()),
            sources.dictionary.take(pa.array(of_group % width)).cast(pa.string()),
            words.dictionary.take(pa.array(found % size)).cast(pa.string()),
            pa.array(total),
            pa.array(docs.astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _plain(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` alone, nulls as empty texts."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    names = ("lang", "source", "text")
    return docs.select(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) for n in names])


def term_counts(docs: DataFrame, *, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, total, first`` of the terms in at least ``min_docs`` documents of
    their language: occurrences in the group and in the language; ``first`` is true in one row of
    each (lang, term).

    Words are counted before the shuffle; then a frequent word is one row for each task and source.
    """
    counted = _plain(docs).mapInArrow(_count, _COUNTS).repartition("term", "lang")
    groups = counted.groupBy("term", "lang", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy("term", "lang")
    return (
        groups.select(
            "lang",
            "source",
            "term",
            "n",
            F.sum("n").over(term).alias("total"),
            F.sum("docs").over(term).alias("docs"),
            (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
        )
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )


def _small(frame: DataFrame) -> DataFrame:
    """A stored frame of few rows goes to all tasks, so that no frequent key is dealt to one; a larger
    one is joined by shuffling, where adaptive execution splits frequent keys."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _groups(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, nth, groups, size, terms, whole``: each occurring group, its number within the
    language, and the sums its shares are taken of."""
    lang = Window.partitionBy("lang")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    wholes = counts.groupBy("lang").agg(
        F.count_if("first").alias("terms"), F.sum("n").alias("whole")
    )
    return (
        _plain(docs)
        .groupBy("lang", "source")
        .agg(F.lit(0).alias("none"))
        .join(sizes, ["lang", "source"], "left")
        .join(wholes, "lang", "left")
        .na.fill(0, ["size", "terms", "whole"])
        .select(
            "lang",
            "source",
            (F.row_number().over(lang.orderBy("source")) - 1).alias("nth"),
            F.count("*").over(lang).cast("int").alias("groups"),
            "size",
            "terms",
            "whole",
        )
    )


def _blocks(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the blocks of terms, dealt to the pairs of runs of groups they meet in.

    A row is a count (``term`` set), or says that a group takes part (``n`` is then the number of terms
    of the block). Each language has a block without terms, so that all its groups meet.
    """
    scale = F.floor(F.log2(F.col("total").cast("double"))).cast("int").alias("scale")
    terms = counts.where("first").select("lang", "term", scale)
    room = F.when(F.col("scale") < int(np.log2(MANY)), TERMS).otherwise(RARE_TERMS)
    scales = terms.groupBy("lang", "scale").agg(F.count("*").alias("all_terms"))
    scales = scales.select("lang", "scale", F.ceil(F.col("all_terms") / room).alias("blocks"))
    scales = _small(stored(scales, "scales"))
    place = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("nth_block")
    placed = counts.select("lang", "source", "term", "n", "first", scale).join(
        scales, ["lang", "scale"]
    )
    groups = _small(groups)
    numbered = groups.select("lang", "source", "nth", "groups")
    entries = placed.select("lang", "source", "term", "n", "first", "scale", place).join(
        numbered, ["lang", "source"]
    )
    sizes = (
        entries.where("first")
        .groupBy("lang", "scale", "nth_block")
        .agg(F.count("*").alias("n"))
        .unionByName(
            groups.select("lang", F.lit(-1).alias("scale"), F.lit(0).alias("nth_block"))
            .distinct()
            .withColumn("n", F.lit(0).cast("long"))
        )
    )
    marks = sizes.join(groups, "lang").select(
        "lang",
        "scale",
        "nth_block",
        "nth",
        "groups",
        F.lit(None).cast("string").alias("term"),
        "n",
        (F.col("size") + SMOOTHING * F.col("terms")).alias("of"),
    )
    rows = entries.select(
        "lang", "scale", "nth_block", "nth", "groups", "term", "n", F.lit(0).cast("long").alias("of")
    ).unionByName(marks)
    run = F.floor(F.col("nth") / GROUPS).cast("int")
    last = F.floor((F.col("groups") - 1) / GROUPS).cast("int")
    return (
        rows.withColumn("run", run)
        .withColumn("partner", F.explode(F.sequence(F.lit(0), last)))
        .select(
            "lang",
            "scale",
            "nth_block",
            F.least("run", "partner").alias("left"),
            F.greatest("run", "partner").alias("right"),
            "nth",
            "term",
            "n",
            "of",
        )
    )


def _levels(rows: pa.Table) -> tuple[np.ndarray, list, np.ndarray]:
    """Group numbers, (levels, level of each row, sum of its shares) of each group, weights of rows.

    The rows are the terms that occur, and one that stands for all that do not.
    """
    marks = rows.filter(rows["term"].is_null())
    numbers, denominators = (marks[name].to_numpy() for name in ("nth", "of"))
    order = np.argsort(numbers)
    numbers, denominators = numbers[order], denominators[order].tolist()
    counts = rows.filter(rows["term"].is_valid())
    named = counts["term"].combine_chunks().dictionary_encode()
    seen = len(named.dictionary)
    matrix = np.zeros((seen + 1, len(numbers)), np.int64)
    columns = np.searchsorted(numbers, counts["nth"].to_numpy())
    matrix[named.indices.to_numpy(), columns] = counts["n"].to_numpy()
    weights = np.ones(seen + 1, np.int64)
    weights[-1] = int(marks["n"][0].as_py()) - seen if len(marks) else 0
    groups = []
    for column, of in zip(matrix.T, denominators, strict=True):
        levels, level = np.unique(column, return_inverse=True)
        groups.append((levels, level, of))
    return numbers, groups, weights


def _runs(groups: list, members: list[int]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Members in runs of about :data:`COLUMNS` indicator columns: members, first columns, matrix."""
    at = 0
    while at < len(members):
        end, width = at, 0
        while end < len(members) and (end == at or width + len(groups[members[end]][0]) <= COLUMNS):
            width += len(groups[members[end]][0])
            end += 1
        some = members[at:end]
        firsts = np.cumsum([0, *[len(groups[g][0]) for g in some]])
        matrix = np.zeros((len(groups[some[0]][1]), width), np.float64)
        for g, first in zip(some, firsts, strict=False):
            matrix[np.arange(len(matrix)), first + groups[g][1]] = 1
        yield some, firsts[:-1], matrix
        at = end


def _products(rows: pa.Table, left: int, right: int):
    """Each exact product of a block: the sides' group numbers, first columns and groups, the counts."""
    numbers, groups, weights = _levels(rows)
    sides = [np.flatnonzero(numbers // GROUPS == run).tolist() for run in (left, right)]
    for some, firsts, one in _runs(groups, sides[0]):
        weighted = (one * weights[:, None]).T
        for others, other_firsts, other in _runs(groups, sides[1]):
            if numbers[some[0]] < numbers[others[-1]]:
                # sums of ones and of one weight: whole numbers far below 2**53
                joint = (weighted @ other).astype(np.int64)
                yield numbers, groups, (some, firsts), (others, other_firsts), joint


def _shares(groups: list, members: list[int]) -> np.ndarray:
    """The share of each (group, level) column, in whole numbers."""
    parts = []
    for g in members:
        levels, _, of = groups[g]
        parts += [1 + SHARES * (n + SMOOTHING) // of if of else 0 for n in levels.tolist()]
    return np.array(parts, np.int64)


def _price(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of differences of the pairs of groups that meet in a block."""
    lang, _, _, left, right = (x.as_py() for x in key)
    ones, others_, values = [], [], []
    for numbers, groups, (some, firsts), (others, other_firsts), joint in _products(rows, left, right):
        prices = np.abs(_shares(groups, some)[:, None] - _shares(groups, others)[None, :])
        sums = np.add.reduceat(joint * prices, firsts, 0)
        sums = np.add.reduceat(sums, other_firsts, 1)
        one, other = numbers[some][:, None], numbers[others][None, :]
        pairs = one < other
        ones.append(np.broadcast_to(one, pairs.shape)[pairs])
        others_.append(np.broadcast_to(other, pairs.shape)[pairs])
        values.append(sums[pairs])
    one, other, value = (np.concatenate(x) if x else np.zeros(0, int) for x in (ones, others_, values))
    return pa.table(
        {
            "lang": pa.array([lang] * len(one), pa.string()),
            "one": pa.array(one, pa.int32()),
            "other": pa.array(other, pa.int32()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _tabulate(key: tuple, rows: pa.Table) -> pa.Table:
    """The cells that are not 0 of the joint tables of a block."""
    lang, _, _, left, right = (x.as_py() for x in key)
    found = []
    for numbers, groups, (some, _), (others, _), joint in _products(rows, left, right):
        sides = []
        for members in (some, others):
            counts = [len(groups[g][0]) for g in members]
            sides += [np.repeat(numbers[members], counts), np.concatenate([groups[g][0] for g in members])]
        a, b = np.nonzero((joint > 0) & (sides[0][:, None] < sides[2][None, :]))
        found.append([sides[0][a], sides[1][a], sides[2][b], sides[3][b], joint[a, b]])
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.zeros(0, int)] * 5
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = ["one", "level", "other", "other_level", "terms"]
    arrays = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
    return pa.table({"lang": pa.array([lang] * len(columns[0]), pa.string()), **arrays})


_BLOCK = ("lang", "scale", "nth_block", "left", "right")


def joint_tables(docs: DataFrame, *, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, level, other_source, other_level, terms``: of each pair of sources of a language
    (the one that sorts first as ``source``) how many kept terms occur ``level`` and ``other_level``
    times there, cells of 0 left out.

    Nulls, long texts and other columns as in :func:`source_divergence`; an empty table, and languages
    without kept terms, have no cells.
    """
    with intermediate(docs.sparkSession):
        counts = stored(term_counts(docs, min_docs=min_docs), "term-counts")
        groups = stored(_groups(docs, counts), "groups")
        cells = _blocks(counts, groups).groupBy(*_BLOCK).applyInArrow(_tabulate, _CELLS)
        cells = cells.groupBy("lang", "one", "level", "other", "other_level")
        groups = _small(groups)
        named = groups.select("lang", F.col("nth").alias("one"), "source")
        others = groups.select("lang", F.col("nth").alias("other"), F.col("source").alias("other_source"))
        result = (
            cells.agg(F.sum("terms").alias("terms"))
            .join(named, ["lang", "one"])
            .join(others, ["lang", "other"])
            .select("lang", "source", "level", "other_source", "other_level", "terms")
        )
        return stored(result, "joint-tables", keep=True)


def _ranked(rows: DataFrame) -> DataFrame:
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(group))


def _share(n: str, of: str) -> str:
    """The share of a term as SQL, exact; terms are there only if ``of`` is not 0."""
    exact = f"{SHARES}BD * ({n} + {SMOOTHING})"
    return f"(1 + {exact} div ({of} + {SMOOTHING} * terms))"


def source_divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) of ``docs`` (``text, lang,
    source``).

    Part ``pair``: each other source of the language by its sum of differences of shares over all
    kept terms (0 if there are none). Part ``term``: the ``top`` terms of the source by how much their
    share is above that in the language. Equal values are ordered by item.

    A null text, language or source is an empty one; a text without words (empty ones too) gives its
    group no term, but the group is there. Texts are read whole, however long. Repeated rows are
    documents of their own. Other columns are not looked at. An empty table gives an empty result.
    """
    with intermediate(docs.sparkSession):
        counts = stored(term_counts(docs, min_docs=min_docs), "term-counts")
        groups = stored(_groups(docs, counts), "groups")
        priced = _blocks(counts, groups).groupBy(*_BLOCK).applyInArrow(_price, _PAIRS)
        sums = priced.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
        groups = _small(groups)
        both = sums.unionByName(
            sums.select("lang", F.col("other").alias("one"), F.col("one").alias("other"), "value")
        )
        named = groups.select("lang", F.col("nth").alias("one"), "source")
        items = groups.select("lang", F.col("nth").alias("other"), F.col("source").alias("item"))
        pairs = both.join(named, ["lang", "one"]).join(items, ["lang", "other"])
        pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        value = F.expr(f"{_share('n', 'size')} - {_share('total', 'whole')}")
        terms = counts.join(groups, ["lang", "source"]).select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")
        )
        terms = _ranked(terms.where("value > 0")).where(F.col("rank") <= top)
        return stored(_ranked(pairs).unionByName(terms), "divergence", keep=True)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL: dict[str, str] = {
    "op13_divergence": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents
), words AS (
  SELECT nr, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term
  HAVING count(DISTINCT nr) >= {MIN_DOCS}
), langs AS (SELECT lang, count(*) AS terms, sum(n) AS whole FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), sizes AS (SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source),
groups AS (
  SELECT DISTINCT docs.lang, docs.source, coalesce(size, 0) AS size
  FROM docs LEFT JOIN sizes USING (lang, source)
), shares AS (
  SELECT lang, source, term, coalesce(counts.n, 0) AS n,
    1 + {SHARES} * (coalesce(counts.n, 0) + {SMOOTHING}) // (size + {SMOOTHING} * terms) AS p,
    1 + {SHARES} * (kept.n + {SMOOTHING}) // (whole + {SMOOTHING} * terms) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)
), rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares AS x JOIN shares AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL
  ) AS sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM rows_
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= {TOP}"""
}
