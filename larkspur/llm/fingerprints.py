r"""Document fingerprints as invertible Bloom lookup sketches.

A document is the set of its passages: it is cut at every line and sentence end and inside them at words that
depend on the text alone, after 16 words at most, so a text of more than 16 words is never one passage. Each passage has
a 64-bit digest whose low 24 bits check the other 40. A sketch has three thirds of cells; a digest
is added to one cell of each third, which keeps a count and the XOR of its digests. Subtracting
two sketches leaves the differing digests only: cells with a count of one and a digest that passes
its check are peeled, one third after the other, which recovers what either side has alone. Pairs
whose difference fills too many cells are peeled from larger sketches, with cells enough for all their digests; those
that do not come out empty are tried again, with four times as many cells each time. Likeness is the Jaccard coefficient that follows from the recovered differences.

Cells are rows ``(document, cell)``. Documents are dealt to the tasks once; every later grouping is by document and cell
inside the same task, so neither cells nor digests are shuffled, and a very long document is many small
rows. All of it is DataFrame operations.

Defined cases: null text is empty; the empty document has no passages and a fingerprint without cells; two
empty documents have likeness 1; repeated passages count once; equal texts have equal fingerprints; repeated rows
have a fingerprint each; no rows give no rows; extra columns are not read. Whole texts are read, however long; a text
and its successor must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.shared import place_in, text_or_empty, written

#: A word, or a piece of a very long one, and the letters that end a passage inside a sentence: every eighth code point.
_WORD, _LAST = r"\S{1,40}+", "".join(chr(c) for c in range(0x41, 0x700) if c % 8 == 7 and chr(c).isalpha())
_RUN = rf"{_WORD}(?:[^\S\n]*+{_WORD})"
#: The letters among them below U+0100, which Java finds in one table, and the others, which it tries one by one.
_NARROW, _WIDE = ("".join(c for c in _LAST if (ord(c) < 0x100) == narrow) for narrow in (True, False))
#: A passage: the fewest words up to a line's, a sentence's or a passage's end, else 16. What ends most of them is asked first, and the
#: long list of letters only behind a letter that may be in it.
PASSAGE = (
    rf"""{_RUN}{{0,15}}?(?=\s|\Z)(?:(?<=[.!?{_NARROW}])|(?=[^\S\n]*(?:\n|\Z))"""
    rf"""|(?<=["'”»){chr(0x100)}-{chr(0x6FF)}])(?:(?<=[.!?]["'”»)])|(?<=[{_WIDE}])))|{_RUN}{{0,15}}+"""
)
#: Cells in each third of a fingerprint.
ROW_CELLS = 21
#: Peeling steps over one sketch; each takes the next third. Sketches with cells for all digests need few: of pairs of 20 to 5,000 digests
#: that all differ, 3 steps solved each of 2,600 in a simulation.
STEPS, WIDE_STEPS = 9, 5
#: Non-empty cells from which on the first sketch of a pair is not peeled: in a simulation 6 steps failed for one in twenty pairs that fill
#: 39 cells and for one in two that fill 50; such pairs are asked of more cells at once.
FULL = 40
#: Low bits of a digest that check its other bits.
CHECK_BITS = 24
#: Times more cells after a failure.
GROWTH = 4


def passages(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PASSAGE), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct passage digests of a text, in order of first appearance."""
    short = F.transform(passages(text), lambda p: F.shiftrightunsigned(F.xxhash64(p), CHECK_BITS))
    return F.array_distinct(F.transform(short, lambda d: F.shiftleft(d, CHECK_BITS).bitwiseOR(_check(d))))


def _check(short: Column) -> Column:
    return F.xxhash64(short).bitwiseAND(F.lit(2**CHECK_BITS - 1))


def _cell(digest: Column, third: Column, size: Column, salt: int) -> Column:
    """A digest's cell in a third of ``size`` cells."""
    return third * size + F.pmod(F.xxhash64(digest, third.cast("int"), F.lit(salt)), size)


def _header(kind: str) -> Column:
    """A document's own row among its digests or cells; it alone carries the document's other columns."""
    return F.filter(F.array(F.lit(None).cast(kind)), lambda _: F.lit(True))


def sketches(rows: DataFrame, by: list[str], sides: list[str]) -> DataFrame:
    """``by, doc`` and ``cells``, the sorted non-empty cells ``(cell, n0, x0, n1, x1, ..)`` of each side's fingerprint.

    ``rows`` has the unique key ``by`` and the struct ``doc``, whose fields ``sides`` are arrays of digests.
    """
    entry = "struct<side:int,d:bigint>"

    def of_side(i: int) -> Column:
        return F.transform(F.col(f"doc.{sides[i]}"), lambda d: F.struct(F.lit(i).alias("side"), d.alias("d")).cast(entry))

    each = rows.select(*by, "doc", F.explode(F.concat(_header(entry), *map(of_side, range(len(sides))))).alias("e"))
    first = F.col("e").isNull()
    placed = each.select(
        *by, F.when(first, F.col("doc")).alias("doc"), F.col("e.side").alias("side"), F.col("e.d").alias("d"),
        F.explode(F.when(first, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(3))))).alias("third"),
    ).withColumn("cell", F.when(F.col("d").isNotNull(), _cell(F.col("d"), F.col("third").cast("long"), F.lit(ROW_CELLS).cast("long"), 0)))
    own = [F.col("side") == i for i in range(len(sides))]
    cells = placed.groupBy(*by, "doc", "cell").agg(
        *(c for i, o in enumerate(own) for c in (F.count_if(o).alias(f"n{i}"), F.bit_xor(F.when(o, F.col("d")).otherwise(F.lit(0).cast("long"))).alias(f"x{i}")))
    )
    fields = [f"{k}{i}" for i in range(len(sides)) for k in "nx"]
    held = F.when(F.col("cell").isNotNull(), F.struct("cell", *fields))
    return cells.groupBy(*by).agg(F.first("doc", ignorenulls=True).alias("doc"), F.sort_array(F.collect_list(held)).alias("cells"))


def encode(cells: Column, side: int) -> Column:
    """A side's fingerprint as text: per non-empty cell its number, count and XOR in hexadecimal."""
    some = F.filter(cells, lambda c: c[f"n{side}"] > 0)
    return F.array_join(F.transform(some, lambda c: F.concat_ws(":", c["cell"], c[f"n{side}"], F.hex(c[f"x{side}"]))), ",")


def subtracted(sketched: DataFrame, by: list[str], pairs: list[tuple[int, int]], sides: list[tuple[str, str]] | None = None) -> DataFrame:
    """The non-empty cells of each pair's difference: ``by, doc, pair, size, cell, n, x``, and a row for each document.

    A pair with ``FULL`` cells or more has the cells of a larger sketch of its ``sides`` (fields of ``doc``) instead; if none are given, one
    cell that cannot be peeled, so it fails without work.
    """
    kind = "struct<pair:int,size:bigint,cell:bigint,n:bigint,x:bigint>"

    def item(p: int, size: Column, cell: Column, n: Column, x: Column) -> Column:
        values = zip(("pair", "size", "cell", "n", "x"), (F.lit(p), size, cell, n, x))
        return F.struct(*(v.alias(c) for c, v in values)).cast(kind)

    def difference(p: int, a: int, b: int) -> Column:
        small = F.lit(ROW_CELLS)
        cells = F.transform("cells", lambda c: item(p, small, c["cell"], c[f"n{a}"] - c[f"n{b}"], c[f"x{a}"].bitwiseXOR(c[f"x{b}"])))
        some = F.filter(cells, lambda c: (c["n"] != 0) | (c["x"] != 0))
        if sides is None:
            # a cell of two that no step can peel stands for a sketch with too many differences
            own, size = lambda _: F.array(item(p, small, F.lit(0), F.lit(2), F.lit(0))), small
        else:
            one, other = (F.col(f"doc.{side}") for side in sides[p])
            signed = lambda digests, sign, size: F.transform(digests, lambda d: item(p, size, F.lit(None), F.lit(sign), d))
            own, size = lambda size: F.concat(signed(one, 1, size), signed(other, -1, size)), enough_cells(one, other)
        both = F.array(F.struct(some.alias("some"), size.alias("size")))
        return F.flatten(F.transform(both, lambda v: F.when(F.size(v["some"]) >= FULL, own(v["size"])).otherwise(v["some"])))

    each = sketched.select(*by, "doc", F.explode(F.concat(_header(kind), *(difference(p, a, b) for p, (a, b) in enumerate(pairs)))).alias("e"))
    each = each.select(*by, F.when(F.col("e").isNull(), F.col("doc")).alias("doc"), "e.*")
    if sides is None:
        return each
    # digests have no cell yet: they go to one in each third
    thirds = F.when(F.col("pair").isNotNull() & F.col("cell").isNull(), F.array(*map(F.lit, range(3)))).otherwise(F.array(F.lit(0)))
    placed = each.withColumn("third", F.explode(thirds)).withColumn("cell", F.coalesce("cell", _cell(F.col("x"), F.col("third").cast("long"), F.col("size"), 0)))
    cells = placed.groupBy(*by, "doc", "pair", "size", "cell").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"))
    return cells.where("doc IS NOT NULL OR n <> 0 OR x <> 0")


def resketched(rows: DataFrame, by: list[str], pairs: list[tuple[str, str]], sizes: list[Column], salt: int) -> DataFrame:
    """The same for larger sketches of those pairs whose ``sizes`` (cells of a third) are not null: signed digests are added up by cell."""
    kind = "struct<pair:int,size:bigint,s:bigint,d:bigint>"

    def signed(p: int, side: str, sign: int, size: Column) -> Column:
        items = F.transform(
            F.col(f"doc.{side}"), lambda d: F.struct(F.lit(p).alias("pair"), size.alias("size"), F.lit(sign).alias("s"), d.alias("d")).cast(kind)
        )
        return F.when(size.isNotNull(), items).otherwise(F.filter(items, lambda _: F.lit(False)))

    items = [signed(p, side, sign, size) for p, ((a, b), size) in enumerate(zip(pairs, sizes)) for side, sign in ((a, 1), (b, -1))]
    each = rows.select(*by, "doc", F.explode(F.concat(_header(kind), *items)).alias("e"))
    first = F.col("e").isNull()
    placed = each.select(
        *by, F.when(first, F.col("doc")).alias("doc"), "e.*",
        F.explode(F.when(first, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(3))))).alias("third"),
    ).withColumn("cell", _cell(F.col("d"), F.col("third").cast("long"), F.col("size"), salt))
    cells = placed.groupBy(*by, "doc", "pair", "size", "cell").agg(F.sum("s").alias("n"), F.bit_xor("d").alias("x"))
    return cells.where("doc IS NOT NULL OR n <> 0 OR x <> 0")


def peeled(cells: DataFrame, by: list[str], salt: int, steps: int = STEPS, listed: int | None = None) -> DataFrame:
    """The cells after peeling, with ``found`` digests as rows of their own; cells that came out empty are gone.

    What is found in sketches of more than ``listed`` cells a third is only counted, in one row for either side, whose ``found`` is 1 or -1
    and whose ``n`` is the number or its negative. So its rows do not go through all later steps.

    A step looks at one third only, where a digest has one cell, so no digest is taken out twice: a pure cell becomes a
    found digest and what it takes from the digest's cells in the other thirds. A few steps are one statement, since Spark
    analyses the plan so far again with each DataFrame call.
    """
    keys, mask = ", ".join(by), 2**CHECK_BITS - 1
    what = "x" if listed is None else f"if(size > {listed}, n, x)"
    state, query = cells.withColumn("found", F.lit(None).cast("long")), "{state}"
    for step in range(steps):
        third, others = step % 3, ((step + 1) % 3, (step + 2) % 3)
        cell = [f"{t} * size + pmod(xxhash64(x, {t}, {salt}), size)" for t in others]
        query = f"""(
            SELECT * FROM (SELECT {keys}, doc, pair, size, found, cell, sum(n) AS n, bit_xor(x) AS x FROM (
              SELECT {keys}, doc, pair, size,
                CASE WHEN pure AND k = 0 THEN {what} ELSE found END AS found,
                CASE WHEN NOT pure THEN cell WHEN k = 1 THEN {cell[0]} WHEN k = 2 THEN {cell[1]} END AS cell,
                CASE WHEN pure AND k > 0 THEN -n ELSE n END AS n,
                CASE WHEN pure AND k = 0 THEN 0L ELSE x END AS x
              FROM (
                SELECT *, coalesce(cell div size = {third} AND abs(n) = 1
                  AND xxhash64(shiftrightunsigned(x, {CHECK_BITS})) & {mask} = x & {mask}
                  AND pmod(xxhash64(x, {third}, {salt}), size) = cell - {third} * size, false) AS pure
                FROM {query}
              ) LATERAL VIEW explode(CASE WHEN pure THEN array(0, 1, 2) ELSE array(0) END) AS k
            )
            GROUP BY {keys}, doc, pair, size, found, cell)
            WHERE doc IS NOT NULL OR n <> 0 OR x <> 0)"""
        if third == 2 or step == steps - 1:
            state, query = cells.sparkSession.sql(f"SELECT * FROM {query}", state=state), "{state}"
    return state


def outcomes(state: DataFrame, by: list[str], n_pairs: int) -> DataFrame:
    """``by, doc`` and per pair a struct ``o<p>(ok, a_only, b_only)`` of what peeling found."""
    aggregates = []
    for p in range(n_pairs):
        own, found = F.col("pair") == p, F.col("found")
        aggregates += [
            (F.count_if(own & found.isNull()) == 0).alias(f"ok{p}"),
            F.collect_list(F.when(own & (F.col("n") > 0), found)).alias(f"a{p}"),
            F.collect_list(F.when(own & (F.col("n") < 0), found)).alias(f"b{p}"),
        ]
    got = state.groupBy(*by).agg(F.first("doc", ignorenulls=True).alias("doc"), *aggregates)
    structs = [F.struct(F.col(f"ok{p}").alias("ok"), F.col(f"a{p}").alias("a_only"), F.col(f"b{p}").alias("b_only")).alias(f"o{p}") for p in range(n_pairs)]
    return got.select(*by, "doc", *structs)


def tallies(state: DataFrame, by: list[str], n_pairs: int) -> DataFrame:
    """``by, doc`` and per pair a struct ``o<p>(ok, a_only, b_only)`` of how many digests peeling found, listed or counted."""
    aggregates = []
    for p in range(n_pairs):
        own, found, n = F.col("pair") == p, F.col("found"), F.col("n")
        aggregates.append((F.count_if(own & found.isNull()) == 0).alias(f"ok{p}"))
        aggregates += [F.sum(F.when(own & found.isNotNull(), F.greatest(sign * n, F.lit(0)))).alias(f"{c}{p}") for c, sign in (("a", 1), ("b", -1))]
    got = state.groupBy(*by).agg(F.first("doc", ignorenulls=True).alias("doc"), *aggregates)
    number = lambda c, alias: F.coalesce(c, F.lit(0)).alias(alias)
    return got.select(*by, "doc", *(F.struct(F.col(f"ok{p}").alias("ok"), number(f"a{p}", "a_only"), number(f"b{p}", "b_only")).alias(f"o{p}") for p in range(n_pairs)))


def enough_cells(a: Column, b: Column) -> Column:
    """Cells of a third, 16 for each digest, that leave next to no chance of failure even if all digests differ; empty ones are no rows."""
    return F.greatest(F.lit(GROWTH * ROW_CELLS).cast("long"), (F.size(a) + F.size(b)).cast("long") * 16)


def likeness(n_a: Column, a_only: Column, b_only: Column) -> Column:
    union = n_a + b_only
    return F.when(union == 0, F.lit(1.0)).otherwise((n_a - a_only) / union)


def differences(pairs: DataFrame, name: str = "pairs") -> DataFrame:
    """What either side of each pair has alone: ``pair, a_only, b_only`` from ``pair, a, b``.

    ``pair`` is a unique key, ``a`` and ``b`` are arrays of digests. Every pair comes back once, however often it is tried.
    """
    todo, out, level = pairs.select("pair", F.struct("a", "b").alias("doc")).repartition("pair").withColumnRenamed("pair", "key"), None, 1
    while True:
        size = enough_cells(F.col("doc.a"), F.col("doc.b")) * GROWTH ** (level - 1)
        cells = resketched(todo, ["key"], [("a", "b")], [size], level)
        tried = outcomes(peeled(cells, ["key"], level, WIDE_STEPS), ["key"], 1)
        tried = written(tried.select("key", "o0.*", F.when(~F.col("o0.ok"), F.col("doc")).alias("doc")), f"{name}-{level}")
        solved = tried.where("ok").select(F.col("key").alias("pair"), "a_only", "b_only")
        out = solved if out is None else out.unionByName(solved)
        if tried.where("NOT ok").isEmpty():
            return out
        todo, level = tried.where("NOT ok").select("key", "doc"), level + 1


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (text) and ``n_passages``; columns of the type map are not supported."""
    doc = F.struct(*docs.columns, digests(text_or_empty(docs[text])).alias("__keys"))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), doc.alias("doc")).repartition("__row")
    sketched = sketches(rows, ["__row"], ["__keys"])
    return sketched.select(*(F.col("doc")[c].alias(c) for c in docs.columns), encode(F.col("cells"), 0).alias("fingerprint"), F.size("doc.__keys").alias("n_passages"))


#: Most quantiles of the ids that part the table, rows of a part, text bytes of a task and most tasks of ``with_next``.
CUTS, PART_ROWS, TASK_BYTES, MOST_TASKS = 1024, 512, 8 << 20, 20_000


def with_next(docs: DataFrame) -> DataFrame:
    """``part, row, doc_id, text, keys`` and ``next_text, next_keys`` of the document that follows by descending doc_id; the last one's is the first's.

    ``(part, row)`` is a unique key and rows of a part are in one task. Keys are the passage digests.

    Ids are parted at their quantiles, and between two quantiles in steps of equal length; a doc_id that many rows share
    is parted by the hash of the text, in whose order such rows follow each other, so only copies of one text under one
    id must share a part. Each part passes its first row on to the part before it. Texts are shuffled
    once, and what is ordered as a whole is one number for each quantile.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    about = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_cuts = min(CUTS, 1 + about["n"] // PART_ROWS)
    tasks = min(MOST_TASKS, 1 + (about["bytes"] or 0) // TASK_BYTES)
    quantiles = rows.agg(F.percentile_approx(key, [i / n_cuts for i in range(n_cuts)], 10 * CUTS).alias("cuts"), F.max(key).alias("top")).first()
    cuts, top = quantiles["cuts"] or [0], quantiles["top"] or 0
    finer = 1 + about["n"] // (n_cuts * PART_ROWS)
    numbers = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    below, upto = (place_in(numbers(cuts), F.col("key"), strict) for strict in (True, False))
    placed = rows.withColumn("key", key).withColumn("below", below).withColumn("upto", upto)
    # ids that fill whole quantiles are spread over them by the hash of the text, smaller hashes behind
    spread = (F.lit(0.5) - F.xxhash64("text") / F.lit(2.0**64)) * (F.col("upto") - F.col("below") - 1)
    lo, hi = (F.element_at(numbers(v), F.greatest("upto", F.lit(1))).cast("double") for v in (cuts, [*cuts[1:], top]))
    inside = (F.col("key").cast("double") - lo) / F.greatest(hi - lo, F.lit(1.0))
    at = F.when(
        F.col("upto") - F.col("below") > 1,
        F.col("below") + 1 + F.least(F.greatest(spread, F.lit(0.0)), F.col("upto") - F.col("below") - F.lit(1.000001)),
    ).otherwise(F.col("upto") + F.least(F.greatest(inside, F.lit(0.0)), F.lit(0.999999)))
    parted = placed.select("doc_id", "text", F.floor(at * finer).cast("long").alias("part")).repartition(tasks, "part")
    group = F.floor(F.col("part") / finer)
    parts = parted.groupBy("part").agg(F.max_by(F.struct("doc_id", "text"), F.struct(key, -F.xxhash64("text").cast("decimal(20,0)"))).alias("first"))
    edges = parts.select("part", group.alias("group")).groupBy("group").agg(F.min("part").alias("low"))
    up = Window.orderBy("group")
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select("group", F.coalesce(F.lead("low").over(up), F.min("low").over(whole)).alias("above"))
    within = Window.partitionBy("group").orderBy("part")
    first = (
        parts.withColumn("group", group)
        .withColumn("before", F.lead("part").over(within))
        # a left join: an inner one would add a filter below the shuffle of the texts, which could not be used twice then
        .join(F.broadcast(edges), "group", "left")
        .select(F.coalesce("before", "above").alias("of_part"), F.col("first.text").alias("first_text"))
    )
    order = Window.partitionBy("part").orderBy(key.desc(), F.xxhash64("text"))
    placed = parted.withColumn("keys", digests(F.col("text"))).select(
        "part", F.row_number().over(order).alias("row"), "doc_id", "text", "keys", F.lead(F.struct("text", "keys")).over(order).alias("next")
    )
    joined = placed.join(first, (F.col("part") == F.col("of_part")) & F.col("next").isNull(), "left")
    return joined.select(
        "part", "row", "doc_id", "text", "keys", F.coalesce("next.text", "first_text").alias("next_text"),
        F.coalesce("next.keys", digests(F.col("first_text"))).alias("next_keys"),
    )
