"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A paragraph is a line; a long line is cut after sentences. Each distinct paragraph digest enters three cells of a
sketch, one per sub-table; a cell sums signs and xors digests and their hashes. Sketches of two versions subtract cell
by cell, which cancels what they share, and peeling cells with a single digest recovers the digests that differ. The
fingerprint is the smallest sketch. Where it cannot be peeled, the difference is sketched anew, larger: digests are dealt
by hash into buckets of about ``LOAD`` digests, each with a sketch of its own, so the work stays in proportion to the
paragraphs; a bucket that fails is sketched anew with larger sub-tables, and after the largest its digests are compared.

Only DataFrame functions are used. Texts are shuffled once, into ranges of doc_id of about equal row counts whose borders
are ids of the table; the first row of a range also enters the range before it, and the first of all the last, so that
every document meets its successor. Rows are ordered by doc_id (null first), then text; repeated rows follow each other.
Rows of one doc_id are not split. Null and empty texts have no paragraphs; two of them are alike (1.0). An empty table
gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.llm.common import texts_of

LINE = r"[^\n]{120,480}?[.!?](?=\s|$)|[^\n]{1,480}"
TABLES, BASE_BITS, RETRY_BITS = 3, 3, (3, 5, 7)
LOAD, ROUNDS = 8, 12
RANGE_ROWS, MAX_RANGES = 512, 16_384
NOTHING = "named_struct('n', 0, 'k', 0L, 'h', 0L)"


# Sketches, as SQL because they nest lambdas.


def paragraph_digests(text: str) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(LINE), F.lit(0)), lambda p: F.xxhash64(p)))


def _signed(digests: str, sign: int, salt: int) -> str:
    return f"transform({digests}, d -> named_struct('n', {sign}, 'k', d, 'h', xxhash64(d, {salt})))"


def _hits(element: str, cell: str, bits: int) -> str:
    """Whether an element belongs to a cell; each sub-table reads its own bits of the hash."""
    mask = (1 << bits) - 1
    return f"(shiftright({element}.h, 32 + {bits} * shiftright({cell}, {bits})) & {mask}) = ({cell} & {mask})"


def _cells(elements: str, bits: int) -> str:
    last = TABLES * (1 << bits) - 1
    return (
        f"transform(sequence(0, {last}), i -> aggregate(filter({elements}, e -> {_hits('e', 'i', bits)}), {NOTHING}, "
        "(a, e) -> named_struct('n', a.n + e.n, 'k', a.k ^ e.k, 'h', a.h ^ e.h)))"
    )


def _peeled(cells: str, bits: int, salt: int) -> str:
    """Digests recovered from a difference, or -1 if cells remain."""
    pure = f"array_distinct(filter(s.cells, x -> abs(x.n) = 1 AND xxhash64(x.k, {salt}) = x.h))"
    rest = (
        f"transform(s.cells, (x, i) -> aggregate(filter(p, q -> {_hits('q', 'i', bits)}), x, "
        "(a, q) -> named_struct('n', a.n - q.n, 'k', a.k ^ q.k, 'h', a.h ^ q.h)))"
    )
    step = (
        f"transform(array({pure}), p -> CASE WHEN size(p) = 0 THEN s "
        f"ELSE named_struct('cells', {rest}, 'found', s.found + size(p)) END)[0]"
    )
    empty = "forall(s.cells, x -> x.n = 0 AND x.k = 0L AND x.h = 0L)"
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'found', 0), (s, r) -> {step}, "
        f"s -> CASE WHEN {empty} THEN s.found ELSE -1 END)"
    )


def _bucket_difference(bucket: str) -> str:
    """Differing digests of one bucket of signed elements: larger sketches until one peels, then a comparison."""
    answer = f"size(array_except(filter({bucket}, e -> e.n = 1).k, filter({bucket}, e -> e.n = -1).k)) + " \
             f"size(array_except(filter({bucket}, e -> e.n = -1).k, filter({bucket}, e -> e.n = 1).k))"
    for salt, bits in reversed(list(enumerate(RETRY_BITS, 1))):
        fresh = f"transform({bucket}, e -> named_struct('n', e.n, 'k', e.k, 'h', xxhash64(e.k, {salt})))"
        attempt = f"transform(array({_peeled(f'transform(array({fresh}), f -> {_cells("f", bits)})[0]', bits, salt)})"
        answer = f"{attempt}, t -> CASE WHEN t >= 0 THEN t ELSE {answer} END)[0]"
    return f"CASE WHEN size({bucket}) = 0 THEN 0 ELSE {answer} END"


def with_difference(frame: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Add ``name``, the number of digests in which two rows' sketches ``left`` and ``right`` differ.

    ``left`` and ``right`` are the prefixes of columns ``*_digests`` and ``*_cells``.
    """
    base = (
        f"zip_with({left}_cells, {right}_cells, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"
    )
    # Bucket counts are powers of two; digests are dealt in two steps, by 2 ** half and then by 2 ** other.
    size = f"size({left}_digests) + size({right}_digests)"
    frame = frame.withColumn(name, F.expr(_peeled(base, BASE_BITS, 0)))
    frame = frame.withColumn("_bits", F.expr(f"CAST(ceil(log2(greatest(1.0D, ({size}) / {LOAD}.0D))) AS INT)"))
    frame = frame.withColumn(
        "_elements",
        F.expr(f"CASE WHEN {name} < 0 THEN concat({_signed(f'{left}_digests', 1, 99)}, {_signed(f'{right}_digests', -1, 99)}) END"),
    )
    coarse = (
        "transform(sequence(0, CAST(shiftleft(1, _bits div 2) AS INT) - 1), g -> "
        "filter(_elements, e -> (e.h & (shiftleft(1L, _bits div 2) - 1)) = g))"
    )
    fine = (
        f"flatten(transform({coarse}, c -> transform(sequence(0, CAST(shiftleft(1, _bits - _bits div 2) AS INT) - 1), b -> "
        "filter(c, e -> (shiftright(e.h, _bits div 2) & (shiftleft(1L, _bits - _bits div 2) - 1)) = b))))"
    )
    retried = f"aggregate({fine}, 0, (total, bucket) -> total + ({_bucket_difference('bucket')}))"
    frame = frame.withColumn(name, F.expr(f"CASE WHEN {name} >= 0 THEN {name} ELSE {retried} END"))
    return frame.drop("_bits", "_elements")


def likeness(difference: str, left: str, right: str) -> Column:
    """One less the share of digests that differ."""
    both = F.size(f"{left}_digests") + F.size(f"{right}_digests")
    return F.when(both == 0, F.lit(1.0)).otherwise(1.0 - F.col(difference) / both)


def sketch_text(cells: str) -> Column:
    """Sign sums as 4, digests and hashes as 16 hexadecimal digits a cell."""
    return F.expr(
        f"array_join(transform({cells}, x -> concat(right(lpad(hex(x.n), 16, '0'), 4), lpad(hex(x.k), 16, '0'), "
        "lpad(hex(x.h), 16, '0'))), '')"
    )


def base_cells(digests: str) -> Column:
    return F.expr(f"transform(array({_signed(digests, 1, 0)}), s -> {_cells('s', BASE_BITS)})[0]")


# Ranges of doc_id.


def _longs(values: list[int], kind: str = "bigint") -> str:
    """An array literal that Spark folds once, however long."""
    return f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)"


def with_successor(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, the next row's text (``_next``), its range and its place there; one extra last row per range."""
    rows = texts_of(docs)
    total, known, smallest = docs.agg(F.count("*"), F.count("doc_id"), F.min(F.col("doc_id").cast("bigint"))).first()
    ranges = min(MAX_RANGES, max(1, total // range_rows))
    borders: list[int] = []
    if ranges > 1 and known:
        shares = _longs([i / ranges for i in range(1, ranges)], "double")
        found = docs.agg(F.expr(f"percentile_approx(cast(doc_id as bigint), {shares}, {20 * ranges})")).first()[0]
        borders = sorted({b for b in found if b > smallest or known < total})
    ordered = F.col("doc_id").asc_nulls_first()
    if borders:
        step = max(1, int(len(borders) ** 0.5))
        block = f"size(filter({_longs(borders[::step])}, b -> b <= doc_id))"
        inside = f"size(filter(slice({_longs(borders)}, ({block} - 1) * {step} + 1, {step}), b -> b <= doc_id))"
        own = F.expr(f"CASE WHEN doc_id IS NULL OR {block} = 0 THEN 0 ELSE ({block} - 1) * {step} + {inside} END")
        is_border = F.expr(f"array_contains({_longs(borders)}, doc_id)")
    else:
        own, is_border = F.lit(0), F.lit(False)
    first = F.col("doc_id").isNull() if known < total else F.col("doc_id") == F.lit(smallest)
    guards = (
        rows.where(is_border | first)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.when(first, F.lit(len(borders))).otherwise(own - 1).alias("_range"), F.lit(True).alias("_guard"))
    )
    dealt = rows.select("doc_id", "text", own.alias("_range"), F.lit(False).alias("_guard")).unionByName(guards)
    along = Window.partitionBy("_range").orderBy("_guard", ordered, "text")
    return dealt.withColumns({"_next": F.lead("text").over(along), "_at": F.row_number().over(along)})


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The sketch of every document and of its edited text, and their likeness to it and to the next document."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)
    )
    versions = (
        with_successor(docs, range_rows)
        .withColumn("_edited", edited)
        .select(
            "doc_id", "_range", "_at", "_guard", F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("_edited", 256).alias("edited_sha256"), paragraph_digests("text").alias("own_digests"),
            paragraph_digests("_edited").alias("edit_digests"),
        )
        .withColumns({"own_cells": base_cells("own_digests"), "edit_cells": base_cells("edit_digests")})
    )
    along = Window.partitionBy("_range").orderBy("_at")
    paired = versions.withColumns(
        {"next_digests": F.lead("own_digests").over(along), "next_cells": F.lead("own_cells").over(along)}
    ).where("NOT _guard")
    compared = with_difference(with_difference(paired, "own", "edit", "_edit"), "own", "next", "_after")
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", sketch_text("own_cells").alias("fingerprint"),
        sketch_text("edit_cells").alias("edited_fingerprint"), likeness("_edit", "own", "edit").alias("near_edited"),
        likeness("_after", "own", "next").alias("near_next"),
    )
