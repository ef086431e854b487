"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector, and the vectors are added
lane by lane, so the order of paragraphs does not count, and a paragraph is put in or taken out by one addition or
subtraction. A fingerprint is an array of longs:

- CHECK longs, each of four lanes modulo 2^16: lanes filled from the paragraph's hash under CHECK seeds. They decide
  equality.
- SKETCH longs, each of two lanes modulo 2^32: a lane adds one bit of the hash of each run of RUN words of a paragraph
  (of all its words, if it has fewer), and one long adds 1 for each run. Runs begin at every word, so an edit touches
  the runs around it only. A text has fewer runs than 2^31, so no lane wraps. Twice a lane less the runs is a sum of
  random signs, so the lanes estimate the inner product of two multisets of runs (the tug-of-war sketch), and with it
  their likeness, without their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, text_of

CHECK, SKETCH, RUN = 16, 32, 4
LOW, HIGH = 0x0000FFFF0000FFFF, -0x0000FFFF00010000  # even and odd lanes of a long
ONES = 0x0001000100010001
LOW32 = 0x00000000FFFFFFFF  # the even lane of a long of two
WORD = r"\S++[^\S\n]*+"
#: Up to RUN words from the first word of a line, and from each other word that has so many.
RUNS = rf"(?dm)(?:^[^\S\n]*+|(?<!\S)(?=(?:{WORD}){{{RUN}}}))(?=((?:{WORD}){{1,{RUN}}}))\S++"


def _add(a: Column, b: Column) -> Column:
    """Adds two longs lane by lane modulo 2^16: even and odd lanes apart, so that no carry crosses."""
    even = (a.bitwiseAND(F.lit(LOW)) + b.bitwiseAND(F.lit(LOW))).bitwiseAND(F.lit(LOW))
    odd = (F.shiftrightunsigned(a, 16).bitwiseAND(F.lit(LOW)) + F.shiftrightunsigned(b, 16).bitwiseAND(F.lit(LOW))).bitwiseAND(F.lit(LOW))
    return even.bitwiseOR(F.shiftleft(odd, 16))


def _negative(a: Column) -> Column:
    """Minus each lane modulo 2^16."""
    return _add(F.bitwise_not(a), F.lit(ONES))


def _add32(a: Column, b: Column) -> Column:
    """Adds two longs lane by lane modulo 2^32."""
    even = (a.bitwiseAND(F.lit(LOW32)) + b.bitwiseAND(F.lit(LOW32))).bitwiseAND(F.lit(LOW32))
    return even.bitwiseOR(F.shiftleft(F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32), 32))


def _negative32(a: Column) -> Column:
    """Minus each lane modulo 2^32."""
    return _add32(F.bitwise_not(a), F.lit(0x0000000100000001))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column as array<long>; a null text counts as the empty one, whose lanes are all 0.

    Time and memory are in proportion to a text's length. The hashes of paragraphs and runs are columns of their own,
    so that each text is cut once.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    paragraphs = F.transform(F.filter(F.split(whole, "\n"), lambda p: p != ""), lambda p: F.xxhash64(p))
    runs = F.transform(F.regexp_extract_all(whole, F.lit(RUNS), F.lit(1)), lambda r: F.xxhash64(F.rtrim(r)))
    cut = rows.withColumn("_paragraphs", paragraphs).withColumn("_runs", runs)
    check = [_check(F.col("_paragraphs"), j) for j in range(CHECK)]
    sketch = F.flatten(F.array(*[_sketch(F.col("_runs"), j) for j in range(SKETCH // 2)]))
    return cut.withColumn(name, F.concat(F.array(*check), sketch, F.array(F.size("_runs").cast("long")))).drop("_paragraphs", "_runs")


def _check(paragraphs: Column, j: int) -> Column:
    """Sum of each paragraph's hash under seed j, as four lanes modulo 2^16."""
    return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda acc, x: _add(acc, F.xxhash64(x, F.lit(j))))


#: Runs that are added without masks: fewer than 2^15, so no lane overflows, nor the long.
PLAIN = 30_000


def _sketch(runs: Column, j: int) -> Column:
    """Two longs: sums of bits j, j + 32 and of bits j + 16, j + 48 of each run's hash, a lane for each."""
    plain = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda acc, x: acc + F.shiftrightunsigned(x, j).bitwiseAND(F.lit(ONES)))
    starts = F.sequence(F.lit(1), F.greatest(F.size(runs), F.lit(1)), F.lit(PLAIN))
    sums = F.transform(starts, lambda at: plain(F.slice(runs, at, F.lit(PLAIN))))
    wide = lambda k: F.aggregate(sums, F.lit(0).cast("long"), lambda acc, x: _add32(acc, F.shiftrightunsigned(x, k).bitwiseAND(F.lit(LOW))))
    return F.array(wide(0), wide(16))


def _lanes(a: Column, b: Column, add, add32) -> Column:
    check = F.zip_with(F.slice(a, 1, CHECK), F.slice(b, 1, CHECK), add)
    return F.concat(check, F.zip_with(F.slice(a, CHECK + 1, SKETCH), F.slice(b, CHECK + 1, SKETCH), add32))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.concat(_lanes(a, b, _add, _add32), F.array(F.element_at(a, -1) + F.element_at(b, -1)))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b, which a has to hold."""
    lanes = _lanes(a, b, lambda x, y: _add(x, _negative(y)), lambda x, y: _add32(x, _negative32(y)))
    return F.concat(lanes, F.array(F.element_at(a, -1) - F.element_at(b, -1)))


def as_text(fp: Column) -> Column:
    """Lowercase hex, 16 digits a long."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def signs(fp: Column) -> Column:
    """The sketch's lanes as sums of signs: twice the lane less the number of runs."""
    n = F.element_at(fp, -1)
    lanes = F.flatten(F.transform(F.slice(fp, CHECK + 1, SKETCH), lambda x: F.array(x.bitwiseAND(F.lit(LOW32)), F.shiftrightunsigned(x, 32))))
    return F.transform(lanes, lambda c: (2 * c - n).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """2 <a, b> / (<a, a> + <b, b>) of two sketches' signs: 1 for equal multisets, near 0 for disjoint ones, within 0 and 1."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    both = dot(a, a) + dot(b, b)
    return F.when(both == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot(a, b) / both)))


def with_next(docs: DataFrame, column: str, derive, buckets: int) -> DataFrame:
    """doc_id, column, what `derive` adds, and next_<c> of each: those of the next document in descending doc_id; after the last comes the first.

    Ranges of doc_id between approximate quantiles are ordered apart. The first row of the range that follows joins
    each range as its last, so no window runs over the whole table, and each text is shuffled once. Repeated doc_ids
    are ordered by the column; a null doc_id is the smallest.
    """
    at = [i / buckets for i in range(1, max(2, buckets))]
    edges = sorted(set(docs.select(F.percentile_approx("doc_id", at, 10_000)).first()[0] or []))
    bucket = F.array_size(F.filter(F.array(*[F.lit(x) for x in edges]).cast("array<long>"), lambda e: e < F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))))) if edges else F.lit(0)
    rows = docs.select("doc_id", column, bucket.alias("_b"), F.lit(0).alias("_guest"))
    first = rows.groupBy("_b").agg(F.max(F.struct("doc_id", column)).alias("_first"))
    down = Window.orderBy(F.col("_b"))
    below = first.select("_b", F.lag("_first").over(down).alias("_next"), F.max("_b").over(Window.partitionBy()).alias("_top"), F.max_by("_first", "_b").over(Window.partitionBy()).alias("_wrap"))
    guests = below.select(F.coalesce("_next", "_wrap").alias("_n"), "_b").select("_n.*", "_b", F.lit(1).alias("_guest"))
    order = Window.partitionBy("_b").orderBy("_guest", *[F.col(c).desc() for c in ("doc_id", column)])
    derived = derive(rows).unionByName(derive(guests))
    led = derived.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in derived.columns if c not in ("doc_id", "_b", "_guest")])
    return led.where("_guest = 0").drop("_guest", "_b")


def edited_text(text: Column, follower: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the follower's first as many."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(follower, F.lit(1), half))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of docs.

    docs: doc_id, text; more columns are ignored. Null texts are empty. A sole document is its own next. An empty
    table gives an empty result.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    led = with_next(docs.select("doc_id", text_of().alias("text")), "text", lambda rows: with_fingerprint(rows, "text", "fp"), buckets)
    edited = led.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fp", "next_fp", edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    both = with_fingerprint(edited, "edited", "edited_fp")
    lanes = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", signs(F.col("fp")).alias("_a"), signs(F.col("edited_fp")).alias("_e"), signs(F.col("next_fp")).alias("_n"))
    return lanes.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_e")).alias("near_edited"), likeness(F.col("_a"), F.col("_n")).alias("near_next"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    return document_fingerprints(documents(spark, sf_dir))
