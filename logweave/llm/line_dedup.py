"""Line dedup as an exact set-similarity join, with DataFrame operations only.

A line's set holds its distinct tokens (runs without white space).  Tokens are ordered by
rarity: all tokens of the corpus are counted in ``BUCKETS`` hash buckets, and the rarity
class of a token's bucket (two thirds of an octave of its count) followed by the low 57 bits of
the token's hash is one long, so sorting a line's longs puts rare tokens first.  The table of
bucket classes has a fixed size, one byte a bucket.

A line is removed when an earlier line of the corpus (by doc_id, then line number) has a
Jaccard similarity of ``num / den`` or more with it, whether or not that earlier line is
removed itself.  Equal sets are one class, represented by its first line.  Classes meet on
the tokens of their prefixes: the larger of two posts its n - ceil(t n) + 1 rarest tokens, the
smaller its n - ceil(2 t n / (1 + t)) + 1 rarest, both by bands of sizes, under a length
filter and a parity sketch of 128 bits (|x ^ y| >= popcount).

A class only needs one earlier match, so every join that looks for partners is a semi-join: it
puts out a posting once, however many others it matches, and large groups of near copies
never expand into pairs.  Semi-joins first keep the postings that some other class may
match, then those with an earlier one; one posting of each class, and then the others of
the classes it leaves open, are compared by all tokens.

Defined cases: null texts have no lines and stay null; lines without tokens are never
matched or removed; white space other than a line feed only separates tokens; rows that
repeat a document (same id and text) are one document and get the same result; null ids
come first; empty tables work; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, small_side

NUM, DEN = 80, 100
#: Rarity buckets; a power of two that the fast map of Spark's hash aggregate (2^16 keys) holds whole.
BUCKETS = 1 << 16
_SHIFT = 64 - BUCKETS.bit_length() + 1
#: Bits of a token's hash that follow its rarity class.
_LOW = 57
#: Bands of sizes a factor e: each is some 4 times as wide as the one before, so that few postings lie in two.
BANDS = 0.72
#: Most documents with removed lines whose line flags are broadcast.
BROADCAST_DOCS = 200_000


def _spaced(text: str):
    """White space other than line feeds becomes spaces; single-character splits need no regex."""
    c = F.col(text)
    for ch in "\t\x0b\x0c\r":
        c = F.replace(c, F.lit(ch), F.lit(" "))
    return c


def _hashes(line):
    return F.transform(F.split(line, " "), lambda t: F.xxhash64(t))


def rarity_classes(docs: DataFrame, text: str = "text") -> Column:
    """Array constant, a long a bucket: the rarity class of every hash bucket by its number of tokens in the whole corpus, 0 the rarest, as high bits."""
    one_line = F.replace(_spaced(text), F.lit("\n"), F.lit(" "))
    token = docs.select(F.explode(F.split(one_line, " ")).alias("t")).where("t != ''")
    count = token.groupBy(F.shiftrightunsigned(F.xxhash64("t"), _SHIFT).alias("b")).count()
    level = F.least(F.floor(F.log2("count") * 1.5), F.lit(63)).cast("int")
    # At most BUCKETS entries, gathered as one short array per 512 buckets.
    rows = count.groupBy(F.shiftright("b", 9).alias("top")).agg(F.collect_list(F.struct(F.col("b").cast("int"), level)).alias("at")).collect()
    table = [0] * BUCKETS
    for row in rows:
        for bucket, value in row["at"]:
            table[bucket] = value << _LOW
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def token_sets(lines: DataFrame, rarity: Column, line: str = "line") -> DataFrame:
    """Adds ``toks``: the distinct tokens of each line as longs, rarest first."""
    low = F.lit((1 << _LOW) - 1).cast("long")

    def pack(h):
        # Never null, so that the arrays are sorted as plain longs.
        level = F.coalesce(F.get(rarity, F.shiftrightunsigned(h, _SHIFT).cast("int")), F.lit(0).cast("long"))
        return level.bitwiseOR(h.bitwiseAND(low))

    toks = F.transform(_hashes(F.col(line)), pack)
    return lines.withColumn("toks", F.sort_array(F.array_except(toks, F.array(pack(F.xxhash64(F.lit("")))))))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), _spaced(text).alias("text"))
    return d.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _need(n):
    """Smallest overlap of an ``n``-token set with any set at the threshold: ceil(n num / den)."""
    return F.ceil(n * NUM / F.lit(DEN))


def _order(prefix: str = ""):
    return F.struct(*[F.col(prefix + c) for c in ("doc_id", "text_key", "line_no")])


def _band(n):
    """Band of a size; a size and the largest that it may match lie in one band or in two that follow each other."""
    return F.floor(F.log(n.cast("double")) * BANDS).cast("int")


def _near(x: str, y: str):
    """Sizes and sketches of the columns n, sk, sh of two aliases allow the threshold: |x ^ y| is at least the bits that differ."""
    nx, ny = F.col(x + ".n"), F.col(y + ".n")
    differ = F.bit_count(F.col(x + ".sk").bitwiseXOR(F.col(y + ".sk"))) + F.bit_count(F.col(x + ".sh").bitwiseXOR(F.col(y + ".sh")))
    return (DEN * F.least(nx, ny) >= NUM * F.greatest(nx, ny)) & ((DEN + NUM) * differ <= (DEN - NUM) * (nx + ny))


def _tokens_of(classes: DataFrame, docs: DataFrame, rarity: Column, doc_id: str, text: str) -> DataFrame:
    """(cid, h2, toks) of ``classes``, from the lines that stand for them."""
    w = classes.groupBy(F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key")).agg(
        F.collect_list(F.struct("line_no", "cid", "h2")).alias("w"))
    w = cut_table(w, "need-lines")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    d = d.join(small_side(w, w.count()), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key")))
    # One split a text; a line is then taken by its number.
    d = d.select(F.split("text", "\n").alias("all"), "w").select("all", F.explode("w").alias("w"))
    lines = d.select("w.cid", "w.h2", F.get("all", F.col("w.line_no")).alias("line")).dropDuplicates(["cid", "h2"])
    lines = lines.withColumn("line", _spaced("line"))
    return token_sets(lines, rarity).select("cid", "h2", "toks")


def _late(posts: DataFrame, later: DataFrame, tokens: DataFrame) -> DataFrame:
    """Classes (cid, h2) among the postings ``later`` that come after a class of ``posts`` at the threshold which shares such a posting."""
    met = (F.col("x.key") == F.col("y.key")) & _near("x", "y") & (F.col("x.at") < F.col("y.at"))
    earlier = posts.alias("x").join(later.alias("y"), met, "left_semi")
    x = cut_table(earlier.join(tokens, ["cid", "h2"]), "earlier")
    y = cut_table(later.join(tokens, ["cid", "h2"]), "later")
    both = F.size(F.array_intersect("x.toks", "y.toks"))
    same = DEN * both >= NUM * (F.col("x.n") + F.col("y.n") - both)
    return cut_table(y.alias("y").join(x.alias("x"), met & same, "left_semi").select("cid", "h2").distinct(), "late")


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, line_no, removed) of every line with a token."""
    rarity = rarity_classes(docs, text)
    # Lines without tokens go by a test of the line: one of the set would be pushed below it and build every set twice.
    t = token_sets(_lines(docs, doc_id, text).where("trim(line) != ''"), rarity).withColumn("n", F.size("toks"))
    # Parity of the tokens per cell of 128: bit 6 of a token tells the words apart.
    both = F.expr("aggregate(toks, 0L, (s, t) -> s ^ shiftleft(1L, cast(t & 63 as int)))")
    high = F.expr("aggregate(toks, 0L, (s, t) -> s ^ shiftleft(shiftright(t, 6) & 1L, cast(t & 63 as int)))")
    # Candidates share the low 31 bits of a prefix token; verification compares the tokens whole.
    prefix = F.transform(F.slice("toks", 1, (F.col("n") - _need(F.col("n")) + 1).cast("int")),
                         lambda t: t.bitwiseAND(F.lit((1 << 31) - 1).cast("long")).cast("int"))
    t = t.select("doc_id", "text_key", "line_no", "n", F.xxhash64("n", "toks").alias("cid"), F.hash("toks").alias("h2"),
                 both.alias("sk"), high.alias("sh"), prefix.alias("prefix"))
    t = cut_table(t.withColumn("sk", F.col("sk").bitwiseXOR(F.col("sh"))), "lines")
    first = F.min(F.struct("doc_id", "text_key", "line_no", "sk", "sh", "prefix")).alias("f")
    classes = t.groupBy("cid", "h2", "n").agg(first, F.count(F.lit(1)).alias("members")).select("cid", "h2", "n", "f.*", "members")
    classes = cut_table(classes, "classes")
    # Sets of fewer than 4 tokens are at the threshold only with themselves.
    smallest = -(-NUM // (DEN - NUM))
    several = classes.where(F.col("n") >= smallest)

    # A partner that is not larger shares one of its own n - ceil(2 t n / (1 + t)) + 1 rarest tokens; these are posted in
    # its band of sizes and in that of the largest set it may match, all others in its band.
    n = F.col("n")
    band, reach = _band(n), _band(F.floor(n * DEN / F.lit(NUM)))
    short = (n - F.ceil(n * 2 * NUM / F.lit(DEN + NUM)) + 1).cast("int")
    posts = several.select("cid", "n", "sk", "sh", "prefix", short.alias("short"), F.array(band).alias("own"),
                           F.array_distinct(F.array(band, reach)).alias("wide"))
    posts = posts.select("cid", "n", "sk", "sh", "short", "own", "wide", F.posexplode("prefix").alias("pos", "tok"))
    posts = posts.select("cid", "n", "sk", "sh", "tok", F.explode(F.when(F.col("pos") < F.col("short"), F.col("wide")).otherwise(F.col("own"))).alias("band"))
    key = F.shiftleft(F.col("tok").cast("long"), 10).bitwiseOR(F.col("band").cast("long"))
    posts = posts.select("cid", "n", "sk", "sh", key.alias("key"))
    # Both sides are the same postings under two aliases, so that one shuffle serves both.
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.cid") != F.col("y.cid")) & _near("x", "y")
    posts = cut_table(posts.alias("x").join(posts.alias("y"), met, "left_semi"), "posts")
    ids = cut_table(posts.select(F.col("cid").alias("need")).distinct(), "need")
    c = classes.select("cid", "h2", _order().alias("at"), "doc_id", "text_key", "line_no").join(
        small_side(ids, ids.count()), F.col("cid") == F.col("need"), "left_semi")
    c = cut_table(c, "near")
    tokens = cut_table(_tokens_of(c, docs, rarity, doc_id, text), "tokens")
    posts = cut_table(posts.join(small_side(c.select("cid", "h2", "at"), c.count()), "cid"), "posts-at")
    earlier = (F.col("x.key") == F.col("y.key")) & _near("x", "y") & (F.col("x.at") < F.col("y.at"))
    later = cut_table(posts.alias("y").join(posts.alias("x"), earlier, "left_semi"), "posts-later")
    # One posting decides nearly every class; the others of a class that it leaves open are looked up next.
    one = later.groupBy("cid", "h2").agg(F.min("key").alias("key"))
    late = _late(posts, later.join(one, ["cid", "h2", "key"], "left_semi"), tokens)
    open_ = cut_table(later.join(late, ["cid", "h2"], "left_anti"), "posts-open")
    if not open_.isEmpty():
        late = late.unionAll(_late(posts, open_, tokens))

    # Classes of one line that is not late lose nothing.
    k = classes.join(late.withColumn("late", F.lit(True)), ["cid", "h2"], "left").where("late or members > 1")
    k = cut_table(k.select("cid", "h2", "n", _order().alias("first"), F.coalesce("late", F.lit(False)).alias("late")), "matched")
    j = t.select("doc_id", "text_key", "line_no", "cid", "h2", "n").join(small_side(k, k.count()), ["cid", "h2", "n"], "left")
    return j.select("doc_id", "text_key", "line_no", F.coalesce(F.col("late") | (_order() != F.col("first")), F.lit(False)).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later matches taken out of ``text``, plus n_lines and n_removed (long, 0 for null texts)."""
    r = removed_lines(docs, doc_id, text).where("removed")
    gone = r.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("__gone"))
    gone = gone.select(F.col("doc_id").alias("__gid"), F.col("text_key").alias("__gkey"), F.sort_array("__gone").alias("__gone"))
    gone = cut_table(gone, "gone")
    d = docs.withColumn("__key", F.xxhash64(F.col(text)))
    d = d.join(small_side(gone, gone.count(), BROADCAST_DOCS),
               F.col(doc_id).eqNullSafe(F.col("__gid")) & (F.col("__key") == F.col("__gkey")), "left")
    # The lines are referred to twice below, so they stay a column and a text is split once.
    d = d.withColumn("__lines", F.split(F.col(text), "\n")).withColumn("__n", F.size("__lines"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone), i -> get(__lines, i)), '\n')")
    d = d.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.col("__n")).cast("long"),
                       "n_removed": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"),
                       text: F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept)})
    return d.drop("__key", "__lines", "__n", "__gid", "__gkey", "__gone")
