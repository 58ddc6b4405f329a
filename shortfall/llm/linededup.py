"""Near-duplicate line removal by a segment-partition edit join (operator 6, native).

Lines of at least ``min_chars`` characters that repeat exactly, and lines of at least
``min_edit_chars`` characters within the edit distance that the shorter one allows (directly or through
others), form a class; only its first occurrence (smallest doc_id, then line number) stays. A line allows an edit for each
``CHARS_PER_EDIT`` characters, ``EDITS`` at most: two edits rewrite a line of five characters, but are a slip in one of
twenty. The query and the pipeline run with ``ALL_LINES``: every line that is not blank, and edits wherever a line allows one.

* A line of length ``l`` that allows ``k`` edits is split into ``k + 1`` segments. By the pigeonhole principle a line
  within the distance holds one of them unchanged, at a start that the two lengths bound; every line
  therefore probes the segment indexes of its own and the few shorter lengths by few substrings.
* Lines meeting at a key are compared with the key's smallest line first; only pairs
  still in different components are compared after that, so a large group is not compared all with all.
* A pair whose counts of common letters differ by more than the edits allow is passed over, inside the
  join already; the others are verified by a banded bit-parallel edit distance (one machine word holds the
  band) over what is left after its common ends.

Everything is DataFrame operations. Defined results: NULL text has no lines; empty and blank lines (spaces, tabs,
carriage returns) and lines under ``min_chars`` always stay; in :func:`classes` NULL doc_id is left alone and rows that
repeat a doc_id count as one document; :func:`remove_lines` takes every row as a document of its own, rows without doc_id
last, and a document of which only blank lines are left goes; an empty table gives no rows. Line ends are ``\\n``; characters are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortfall.llm.graph import components, free_shuffles
from shortfall.llm.rowkeys import fresh, keyed, unkeyed
from shortfall.session import pin, pin_folder

EDITS = 2
MIN_CHARS = 10
MIN_EDIT_CHARS = 30
CHARS_PER_EDIT = 10
#: No line is left out but blank ones; a line under ``CHARS_PER_EDIT`` characters allows no edit.
ALL_LINES = {"min_chars": 1, "min_edit_chars": CHARS_PER_EDIT}
#: Classes that may be broadcast: those with at least that part of all lines in classes.
BROADCAST_CLASSES = 10_000
#: Documents whose ids may be broadcast to fetch their lines.
BROADCAST_DOCS = 500_000


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line_no, line) of the lines that take part."""
    return (docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
            .where((F.length("line") >= min_chars) & (F.btrim("line", F.lit(" \t\r")) != "")))


def _id(line: str) -> Column:
    """A line's number: a hash whose lowest bit is free."""
    return F.xxhash64(line).bitwiseAND(-2)


def _check(line: str) -> Column:
    """A second hash: lines are the same if both hashes are."""
    return F.xxhash64(F.lit("line"), line)


def allowed(length: Column | str, edits: int = EDITS) -> Column:
    """Edits that a line of this length allows."""
    return F.least(F.lit(edits), F.floor((F.col(length) if isinstance(length, str) else length) / CHARS_PER_EDIT).cast("int"))


def _specs(edits: int) -> list[tuple[int, bool, int, int, int]]:
    """(edits, probe, segment, how much shorter the indexed line is, offset) for lines that allow ``edits``."""
    specs = [(edits, False, i, 0, 0) for i in range(edits + 1)]
    for shorter in range(edits + 1):
        for i in range(edits + 1):                  # i counts from 0; the bounds are those of multi-match-aware selection
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            specs += [(edits, True, i, shorter, off) for off in range(low, high + 1)]
    return specs


def segment_keys(texts: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(key, code) of the distinct lines ``texts (line, h)``: one index row per segment, and a probe
    row for each substring that a line within the distance and not longer could have as its segment.
    The code is ``h``, plus 1 in a probe row."""
    listed = lambda specs: F.array(*[F.struct(F.lit(e).alias("e"), F.lit(p).alias("probe"), F.lit(i).alias("i"), F.lit(d).alias("d"), F.lit(o).alias("off")) for e, p, i, d, o in specs])
    of = [_specs(e) for e in range(1, edits + 1)]
    length = F.length("line")
    spec = F.when(length >= (CHARS_PER_EDIT + 1) * edits, listed(of[-1])).otherwise(listed([x for some in of for x in some]))
    rows = (texts.select("line", "h", length.alias("n"), F.explode(spec).alias("s"))
            .select("line", "h", "n", "s.e", "s.probe", "s.i", "s.off", (F.col("n") - F.col("s.d")).alias("l")).where(F.col("l") >= min_chars).where(allowed("l", edits) == F.col("e")))
    parts = F.col("e") + 1
    base, longer = F.floor(F.col("l") / parts).cast("int"), F.col("l") % parts          # the last `longer` segments have one more
    size = base + F.when(F.col("i") >= parts - longer, 1).otherwise(0)
    start = F.col("i") * base + F.greatest(F.lit(0), F.col("i") - (parts - longer)) + F.col("off") + 1
    return (rows.withColumn("start", start).withColumn("size", size).where("start >= 1 AND start + size - 1 <= n")
            .select(F.xxhash64("i", "l", F.col("line").substr(F.col("start"), F.col("size"))).alias("key"), F.col("h").bitwiseOR(F.col("probe").cast("bigint")).alias("code")))


def _common_start(a: Column, b: Column) -> Column:
    """Length of the common prefix, by doubling steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, k: F.when(
        (n + k <= F.least(F.length(a), F.length(b))) & (F.substring(a, n + 1, k) == F.substring(b, n + 1, k)), n + k).otherwise(n))


def within_edits(pairs: DataFrame, a: str, b: str, edits: int, limit: Column | None = None) -> DataFrame:
    """The rows whose strings ``a`` and ``b`` are within the edit distance; with ``limit`` (a row's own limit,
    ``edits`` at most) within that. All limits share one walk: it gives the distance wherever that is ``edits`` at most.

    After the common ends are cut off, the columns of the edit matrix are walked with a word that
    holds the vertical differences in a band of ``2 edits + 2`` diagonals: down the lowest diagonal first,
    then along the last row.
    """
    if not 0 <= edits <= 28:
        raise ValueError("edits must fit the band of one machine word")
    # each step is the output of a generator, so that the filter is not pushed below and computes it again and again
    step = lambda df, name, value: df.select("*", F.explode(F.array(value)).alias(name))
    rows = pairs.withColumn("_k", F.lit(edits) if limit is None else limit).where((F.abs(F.length(a) - F.length(b)) <= F.col("_k")) & (F.col("_k") <= edits))
    rows = step(rows, "_p", _common_start(F.col(a), F.col(b)))
    rest = lambda c: F.reverse(F.col(c).substr(F.col("_p") + 1, F.length(c)))
    rows = step(rows, "_r", F.struct(rest(a).alias("x"), rest(b).alias("y")))
    rows = step(rows, "_s", _common_start(F.col("_r.x"), F.col("_r.y")))
    x, y = (F.col(c).substr(F.col("_s") + 1, F.length(c)) for c in ("_r.x", "_r.y"))        # reversed: the distance is the same
    swap = F.length("_r.x") < F.length("_r.y")
    rows = step(rows, "_t", F.struct(F.split(F.when(swap, y).otherwise(x), "").alias("long"), F.split(F.when(swap, x).otherwise(y), "").alias("short"),
                                     (F.greatest(F.length("_r.x"), F.length("_r.y")) - F.col("_s")).alias("m"), (F.least(F.length("_r.x"), F.length("_r.y")) - F.col("_s")).alias("n")))

    width = 2 * edits + 2
    mask, one = (1 << width) - 1, F.lit(1).cast("bigint")
    word = lambda v: F.lit(v).cast("bigint")

    def column(s: Column, j: Column) -> Column:
        equal = word(0)
        for k in range(width):                      # bit k is row j + edits - (width - 1 - k)
            at = j + (edits - (width - 1 - k))
            equal = equal + F.when((at >= 0) & (F.get("_t.long", at) == F.get("_t.short", j)), word(1 << k)).otherwise(word(0))
        lets = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731  a name for a value
        return lets(equal, lambda x: lets(
            ((x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(mask), lambda d0: lets(
                F.struct(s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"])).bitwiseAND(mask)).alias("hp"), d0.bitwiseAND(s["vp"]).alias("hn")), lambda h: F.struct(
                    h["hn"].bitwiseOR(F.bitwise_not(F.shiftright(d0, 1).bitwiseOR(h["hp"])).bitwiseAND(mask)).alias("vp"),
                    F.shiftright(d0, 1).bitwiseAND(h["hp"]).alias("vn"),
                    F.when(j < F.col("_t.m") - edits, s["dist"] + F.when(d0.bitwiseAND(1 << (width - 1)) == 0, 1).otherwise(0))
                    .otherwise(s["dist"] + F.when(h["hp"].bitwiseAND(s["row"]) != 0, 1).otherwise(0) - F.when(h["hn"].bitwiseAND(s["row"]) != 0, 1).otherwise(0)).alias("dist"),
                    F.when(j < F.col("_t.m") - edits, s["row"]).otherwise(F.shiftright(s["row"], 1)).alias("row")))))

    start = F.struct(word(((1 << (edits + 1)) - 1) << (width - edits - 1)).alias("vp"), word(0).alias("vn"), F.lit(edits).alias("dist"), (one * (1 << (width - 2))).alias("row"))
    distance = F.aggregate(F.sequence(F.lit(0), F.col("_t.n") - 1), start, column, lambda s: s["dist"])
    found = F.when(F.col("_t.m") <= F.col("_k"), True).when(F.col("_t.n") == 0, False)
    if limit is not None:                           # strings that the band is too wide for
        found = found.when(F.col("_t.m") < edits, F.levenshtein(F.array_join("_t.long", ""), F.array_join("_t.short", "")) <= F.col("_k"))
    return rows.where(found.otherwise(distance <= F.col("_k"))).select(*pairs.columns)


# Letters that are counted, by their frequency in Latin-script text.
LETTERS = "etaoinsrhldcumpg"


def _letters(line: str) -> list[Column]:
    """Counts of ``LETTERS``, eight bits each, in two numbers; larger counts as 255."""
    counts = [F.least(F.length(line) - F.length(F.replace(F.col(line), F.lit(c), F.lit(""))), F.lit(255)).cast("bigint") for c in LETTERS]
    packed = []
    for half in (counts[:8], counts[8:]):
        total = half[0]
        for k, n in enumerate(half[1:], 1):
            total = total.bitwiseOR(F.shiftleft(n, 8 * k))
        packed.append(total)
    return packed


def _letters_near(edits: int) -> Column:
    """An edit changes at most two counts by one."""
    total = F.lit(0).cast("bigint")
    for x, y in (("a_s", "b_s"), ("a_t", "b_t")):
        for k in range(8):
            at = lambda c, k=k: F.shiftrightunsigned(F.col(c), 8 * k).bitwiseAND(255)
            total = total + F.abs(at(x) - at(y))
    return total <= 2 * edits


def _fetch(docs: DataFrame, ids: DataFrame, owners: DataFrame, min_chars: int) -> DataFrame:
    """(h, line, s, t) of the lines ``ids (h)``, read again from the documents that own them, with their letter counts."""
    wanted = owners.join(ids, "h").select("h", "check", F.col("owner").alias("doc_id"))
    where = wanted.select("doc_id").distinct()
    if where.count() <= BROADCAST_DOCS:
        where = F.broadcast(where)
    found = lines(docs.join(where, "doc_id", "left_semi").select("doc_id", "text"), min_chars).select("doc_id", "line", _id("line").alias("h"), _check("line").alias("check"))
    s, t = _letters("line")
    return found.join(wanted, ["doc_id", "h", "check"]).select("h", "line").distinct().select("h", "line", s.alias("s"), t.alias("t"))


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    # letter counts first: texts are fetched for what they leave
    marks = lambda x: texts.select(F.col("h").alias(x), F.col("s").alias(f"{x}_s"), F.col("t").alias(f"{x}_t"))
    close = pairs.join(marks("a"), "a").join(marks("b"), "b").where(_letters_near(edits)).select("a", "b")
    both = (close.join(texts.select(F.col("h").alias("a"), F.col("line").alias("a_line")), "a")
            .join(texts.select(F.col("h").alias("b"), F.col("line").alias("b_line")), "b"))
    limit = allowed(F.least(F.length("a_line"), F.length("b_line")), edits)
    return within_edits(both.where(limit > 0), "a_line", "b_line", edits, limit).select("a", "b")


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    of = lambda x: known.select(F.col("node").alias(x), F.col("component").alias(f"{x}_c"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .where(F.coalesce("a_c", "a") != F.coalesce("b_c", "b")).select("a", "b"))


def near_lines(docs: DataFrame, owners: DataFrame, edits: int, min_edit_chars: int, folder: str) -> DataFrame:
    """(node, component) of lines (by hash) that have a near line."""
    texts = lines(docs, min_edit_chars).groupBy("line").agg(F.count("*").alias("n")).select("line", _id("line").alias("h"))
    by_key = Window.partitionBy("key")
    # dealt by key before anything is added, so that only key and code travel
    met = (segment_keys(texts, edits, min_edit_chars).repartition("key")
           .select("key", (F.col("code").bitwiseAND(1) == 1).alias("probe"), F.col("code").bitwiseAND(-2).alias("h"))
           .withColumn("head", F.min(F.when(~F.col("probe"), F.col("h"))).over(by_key))
           .withColumn("low", F.min("h").over(by_key)).withColumn("high", F.max("h").over(by_key))
           .where("head IS NOT NULL AND low <> high").select("key", "probe", "h", "head"))
    met = pin(met, "keys", folder)
    free_shuffles(docs.sparkSession)
    stars = pin(met.where("h <> head").select(F.least("head", "h").alias("a"), F.greatest("head", "h").alias("b")).distinct(), "stars", folder)
    text = pin(_fetch(docs, stars.select(F.col("a").alias("h")).union(stars.select("b")).distinct(), owners, min_edit_chars), "texts", folder)
    links = pin(_verified(stars, text, edits), "links", folder)
    free_shuffles(docs.sparkSession)
    known = pin(components(links), "known", folder)
    free_shuffles(docs.sparkSession)
    placed = met.join(known, met["h"] == known["node"], "left").select("key", "probe", "h", "head", F.coalesce("component", "h").alias("c"))
    head = known.select(F.col("node").alias("head"), F.col("component").alias("k"))
    tagged = placed.join(head, "head", "left").withColumn("k", F.coalesce("k", "head")).where("h <> head")
    tagged = pin(tagged.join(text.select("h", "s", "t"), "h"), "tagged", folder)      # plans of their own: what the driver plans at once stays small
    outside = tagged.where("c <> k").select("key", F.col("probe").alias("a_probe"), F.col("h").alias("a"), F.col("c").alias("a_c"), F.col("s").alias("a_s"), F.col("t").alias("a_t"))
    inside = tagged.select("key", F.col("probe").alias("b_probe"), F.col("h").alias("b"), F.col("c").alias("b_c"), F.col("s").alias("b_s"), F.col("t").alias("b_t"), (F.col("c") == F.col("k")).alias("member"))
    rest = (outside.join(inside, "key").where((F.col("a_probe") != F.col("b_probe")) & (F.col("a_c") != F.col("b_c")) & (F.col("member") | (F.col("a") < F.col("b"))) & _letters_near(edits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rest = pin(rest, "rest", folder)
    free_shuffles(docs.sparkSession)
    more = pin(_verified(rest, text, edits), "more", folder)
    return known if more.isEmpty() else components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, min_edit_chars: int = MIN_EDIT_CHARS) -> DataFrame:
    """(doc_id, line_no, class_doc, class_line, removed): every occurrence of a line in a class of at
    least two occurrences; the class is named by its first occurrence."""
    if edits and min_edit_chars < CHARS_PER_EDIT:
        raise ValueError(f"lines under {CHARS_PER_EDIT} characters allow no edit")
    folder = pin_folder(docs.sparkSession)
    seen = pin(lines(docs, min_chars).select("doc_id", "line_no", _id("line").alias("h"), _check("line").alias("check")), "lines", folder)
    distinct = pin(seen.groupBy("h", "check").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"))
                   .select("h", "check", F.col("first.doc_id").alias("owner"), F.col("first.line_no").alias("owner_line"), "n"), "distinct", folder)
    near = near_lines(docs, distinct, edits, min_edit_chars, folder) if edits else distinct.select(F.col("h").alias("node"), F.col("h").alias("component")).limit(0)
    grouped = pin(distinct.join(near, distinct["h"] == near["node"], "left")
                  .where("n > 1 OR component IS NOT NULL")
                  .select("h", "check", F.struct("owner", "owner_line").alias("first"), F.coalesce("component", "h").alias("c"),
                          F.when(F.col("component").isNull(), F.col("check")).otherwise(F.lit(0)).alias("c2")), "grouped", folder)
    named = seen.join(_named(grouped, folder), ["h", "check"])
    return named.select("doc_id", "line_no", "class_doc", "class_line", ((F.col("doc_id") != F.col("class_doc")) | (F.col("line_no") != F.col("class_line"))).alias("removed"))


def _named(grouped: DataFrame, folder: str) -> DataFrame:
    """(h, check, class_doc, class_line) of the lines in classes. The few classes that hold many of them are
    broadcast, so that no class is one task's."""
    first = pin(grouped.groupBy("c", "c2").agg(F.min("first").alias("first"), F.count("*").alias("n"))
                .select("c", "c2", F.col("first.owner").alias("class_doc"), F.col("first.owner_line").alias("class_line"), "n"), "first", folder)
    rows = grouped.select("h", "check", "c", "c2")
    many = max(1000, grouped.count() // BROADCAST_CLASSES)                      # at most BROADCAST_CLASSES classes are as large
    large = first.where(F.col("n") >= many).drop("n")
    small = first.where(F.col("n") < many).drop("n")
    of_large = rows.join(F.broadcast(large), ["c", "c2"])
    of_small = rows.join(F.broadcast(large.select("c", "c2")), ["c", "c2"], "left_anti").join(small, ["c", "c2"])
    return of_large.unionByName(of_small).select("h", "check", "class_doc", "class_line")


def remove_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, min_edit_chars: int = MIN_EDIT_CHARS) -> DataFrame:
    """``docs`` without the later lines of each class; ``n_chars`` (if there) follows the text."""
    columns, docs = docs.columns, keyed(docs)
    own, cut = fresh("_doc", docs.columns), fresh("_gone", docs.columns)
    gone = (classes(docs, edits, min_chars, min_edit_chars).where("removed").groupBy(F.col("doc_id").alias(own))
            .agg(F.collect_set("line_no").alias(cut)))                           # lines of one document
    joined = docs.join(gone, docs["doc_id"] == F.col(own), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col(cut), i)), "\n")
    out = joined.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept)).where(F.col(cut).isNull() | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return unkeyed(out, columns)
