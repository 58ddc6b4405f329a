"""Document fingerprints by consistent weighted sampling (operator 5, native).

A text is a bag of words weighted by their counts. For each of ``SAMPLES`` draws every
word has its own gamma(2, 1) variables r and c and a uniform b, drawn from hashes
of the word. With weight S the draw's level is t = floor(ln S / r + b), its value
ln c - r (t - b + 1), and the word with the least value is the sample, together with
its level. Two texts agree in a draw with a probability equal to their generalised Jaccard
similarity, sum of minima over sum of maxima of the counts. The fingerprint is the
list of samples, 32 bits each in hexadecimal.

Everything is DataFrame operations; words, counts and minima of a document are computed where the
document's text lies (rows are dealt by doc_id once), in hash aggregates on fixed-width columns.

Defined results: NULL text is empty; a text without words has an empty fingerprint, which is like another
empty one (1) and unlike any other (0); words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing; rows that
repeat as a whole give one row, those that share only a doc_id follow each other by a hash of their text; an empty table gives no rows; the only document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortfall.llm.graph import free_shuffles
from shortfall.operators.ordinal import sequence
from shortfall.session import pin, pin_folder

SAMPLES = 32
_LOW = 0xFFFFFFFF
_NO_ID = -(1 << 63)
#: Values are kept in steps of 2**-24 above -100 (they lie between about -90 and 4).
_STEP = float(1 << 24)


def _unit(bits: Column) -> Column:
    """A uniform number in (0, 1) from 32 bits."""
    return (bits + F.lit(0.5)) / float(1 << 32)


def _sample(i: int) -> Column:
    """Draw ``i`` of a word as one sortable number: the value above, the sample's 32 bits below."""
    g, h = F.xxhash64("_word", F.lit(2 * i)), F.xxhash64("_word", F.lit(2 * i + 1))
    r = -F.log(_unit(g.bitwiseAND(_LOW)) * _unit(F.shiftrightunsigned(g, 32)))
    c = -F.log(_unit(h.bitwiseAND(_LOW)) * _unit(F.shiftrightunsigned(h, 32)))
    b = _unit(g.bitwiseXOR(F.shiftrightunsigned(h, 17)).bitwiseAND(_LOW))
    t = F.floor(F.col("_ln_s") / r + b)
    value = F.log(c) - r * (t - b + 1)
    name = F.xxhash64("_word", t).bitwiseAND(_LOW)
    return F.shiftleft(F.floor((value + 100.0) * _STEP), 32).bitwiseOR(name)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``fingerprint`` of each row's ``text`` that has words; the keys name a row.

    If the rows are dealt by one of the keys already, nothing is moved.
    """
    terms = (texts.select(*keys, F.explode(words(F.col("text"))).alias("_w")).select(*keys, F.xxhash64("_w").alias("_word"))
             .groupBy(*keys, "_word").agg(F.log(F.count("*").cast("double")).alias("_ln_s")))
    drawn = terms.groupBy(*keys).agg(*[F.min(_sample(i)).alias(f"m{i}") for i in range(samples)])
    hexed = [F.substring(F.hex(F.col(f"m{i}").bitwiseAND(_LOW).bitwiseOR(F.lit(1 << 32))), 2, 8) for i in range(samples)]
    return drawn.select(*keys, F.concat(*hexed).alias("fingerprint"))


def likeness(a: str, b: str) -> Column:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    n = F.length(a) / 8
    equal = F.aggregate(F.sequence(F.lit(0), (n - 1).cast("int")), F.lit(0), lambda s, i: s + (F.substring(a, i * 8 + 1, 8) == F.substring(b, i * 8 + 1, 8)).cast("int"))
    return (F.when((F.length(a) == 0) | (F.length(b) == 0), (F.length(a) == F.length(b)).cast("double")).otherwise(equal / n))


def _base(docs: DataFrame) -> DataFrame:
    """(k, mark, text): doc_id with NULL as the smallest number, and a hash that tells rows of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("k"), text.alias("text")).withColumn("mark", F.xxhash64("text"))


def _same(left: str, right: str) -> Column:
    """Equality that is no join key, so that rows dealt by ``k`` stay where they are."""
    return F.col(left).bitwiseXOR(F.col(right)) == 0


def neighbours(base: DataFrame, folder: str) -> DataFrame:
    """(k, mark, n, next_k, next_mark, to_k, to_mark, half): the next document by descending doc_id, and
    the document whose next this is, with the number of characters it takes from here."""
    rows = base.groupBy("k", "mark").agg(F.max(F.length("text")).alias("n"))
    order = sequence(rows, [F.col("k").desc(), F.col("mark").desc()], "row", start=0, folder=folder)
    last = F.lit(order.agg(F.max("row")).first()[0]).cast("long")
    after = F.when(F.col("row") == last, 0).otherwise(F.col("row") + 1).cast("long")
    before = F.when(F.col("row") == 0, last).otherwise(F.col("row") - 1).cast("long")
    plan = order.select("k", "mark", "n", after.alias("after"), before.alias("before"))
    next_ = order.select(F.col("row").alias("after"), F.col("k").alias("next_k"), F.col("mark").alias("next_mark"))
    to = order.select(F.col("row").alias("before"), F.col("k").alias("to_k"), F.col("mark").alias("to_mark"), F.floor(F.col("n") / 2).cast("int").alias("half"))
    return plan.join(next_, "after").join(to, "before").select("k", "mark", "n", "next_k", "next_mark", "to_k", "to_mark", "half")


def edits(base: DataFrame, plan: DataFrame) -> DataFrame:
    """(k, mark, text, edited): the last floor(n/2) characters replaced by the first as many of the next document.

    Texts are dealt by ``k`` once; only the taken starts move a second time.
    """
    links = plan.select(F.col("k").alias("pk"), F.col("mark").alias("pmark"), "n", "to_k", "to_mark", "half")
    own = base.join(links, (F.col("k") == F.col("pk")) & _same("mark", "pmark")).select("k", "mark", "text", "n", "to_k", "to_mark", "half")
    taken = own.select(F.col("to_k").alias("tk"), F.col("to_mark").alias("tmark"), F.col("text").substr(F.lit(1), F.col("half")).alias("start"))
    kept = F.col("text").substr(F.lit(1), (F.col("n") - F.floor(F.col("n") / 2)).cast("int"))
    return (own.select("k", "mark", "text", "n").join(taken, (F.col("k") == F.col("tk")) & _same("mark", "tmark"))
            .select("k", "mark", "n", "text", F.concat(kept, "start").alias("edited")))


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    folder = pin_folder(docs.sparkSession)
    base = _base(docs)
    plan = pin(neighbours(base, folder), "neighbours", folder)
    if base.select("k").count() != plan.count():                                  # rows repeat as a whole
        base = base.dropDuplicates(["k", "mark"])
    both = edits(base, plan)
    versions = both.select("k", "mark", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("v"))
    prints = fingerprints(versions.select("k", "mark", "v.which", F.col("v.t").alias("text")), ["k", "mark", "which"], samples)
    prints = prints.groupBy("k", "mark").agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("f"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("e"))
    about = both.select("k", "mark", F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    mine = prints.select(F.col("k").alias("fk"), F.col("mark").alias("fmark"), F.col("f"), F.col("e"))
    # one plan for both, so that texts are moved once
    prints = pin(about.join(mine, (F.col("k") == F.col("fk")) & _same("mark", "fmark"), "left").drop("fk", "fmark"), "prints", folder)
    free_shuffles(docs.sparkSession)
    later = prints.select(F.col("k").alias("nk"), F.col("mark").alias("nmark"), F.col("f").alias("next_f"))
    steps = plan.select(F.col("k").alias("pk"), F.col("mark").alias("pmark"), "next_k", "next_mark")
    following = (steps.join(later, (F.col("next_k") == F.col("nk")) & _same("next_mark", "nmark"), "left").select("pk", "pmark", "next_f"))
    out = prints.join(following, (F.col("k") == F.col("pk")) & _same("mark", "pmark"), "left")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return (out.select("k", "n_chars", "edited_sha256", empty("f"), empty("e"), empty("next_f"))
            .select(F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", F.col("f").alias("fingerprint"),
                    F.col("e").alias("edited_fingerprint"), likeness("f", "e").alias("near_edited"), likeness("f", "next_f").alias("near_next")))
