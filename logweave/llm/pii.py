r"""Personal data by candidate gradient boosting, with DataFrame and Spark ML operations only.

High-recall generators propose overlapping spans over whole texts.  Those of the four
*base* patterns that pass their checks are always redacted.  The other candidates (the
strict forms, which also lie inside failed base matches, and obfuscated or national forms)
are scored by gradient boosted trees over format and context features and accepted
from a threshold per kind, calibrated on held-out documents.

Training labels come from the corpus itself: a candidate equal to a valid base span is
positive, and so are valid base spans rewritten into the forms of the wide generators
(national phones, spelled addresses); one that overlaps a valid base span without lying
inside one of its kind, or a failed base match, is negative.  Of the others, which are the
ones to be scored, those without a check of their own (Luhn, octets) train as negatives of
weight ``UNKNOWN``, so that number lists found in plenty stay; thresholds are calibrated on
known labels only.  Rows are first aggregated to distinct feature vectors with counts, so
the trees train on a small weighted table.

Accepted candidates do not overlap base spans.  One that lies inside an accepted one of its
kind goes; within each run of overlaps the best scores are taken first, and one that
overlaps none taken before it stays.

Defined cases: null texts are empty; repeated rows (same id and text) get equal results;
null ids are ids; without positive or without negative candidates there is no model and
only base spans are returned; empty tables work; extra columns are ignored.  Positions
are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, small_side

KINDS = ("email", "ip", "card", "phone")
#: (kind, is base, pattern).  The base patterns are those of the contract with possessive quantifiers where
#: nothing can be given back, and an anchor at the start of a run of name characters: same matches, linear time.
_MAIL = "[A-Za-z0-9._%+-]"
GENERATORS = (
    ("email", True, rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"),
    ("card", True, r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, rf"(?:\G|(?<!{_MAIL})){_MAIL}++(?:\x20?[\[(]at[\])]\x20?|\x20at\x20|@)[A-Za-z0-9-]++"
                     r"(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++"),
    ("ip", False, r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"),
    ("card", False, r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])"),
    ("card", False, r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9A-Za-z])"),
    ("phone", False, r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-][0-9]{2,4}(?![0-9])){1,4}"),
    # Not a part of a longer row of digit groups.
    ("phone", False, r"(?<![0-9A-Za-z.+-])(?<![0-9][\x20.-])(?:1[\x20.-])?(?:\([0-9]{2,5}\)[\x20.-]?|[0-9]{2,5}[\x20.-])"
                     r"[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]|[\x20.-][0-9])"),
)
CONTEXT = 24
CUES = {"email": "mail|contact|kontakt|correo|courriel", "ip": r"\bip\b|host|addr|server|login",
        "card": "card|karte|carte|tarjeta|visa|credit", "phone": r"\btel|phone|fon|call|fax|mobil|cell"}
FEATURES = ("sort", "n_digits", "n_chars", "n_letters", "n_seps", "plus", "paren", "spelled", "luhn", "octets", "left", "right", "cue")
TREES, DEPTH = 8, 4
MIN_PRECISION = 0.99
#: Weight, as a negative example, of a candidate that nothing is known about.
UNKNOWN = 0.1
#: Least share of the training weight in a leaf.
LEAF_SHARE = 0.001
TEST_FOLD = "pmod(crc32(cast(coalesce(cast(doc_id as string), '') as binary)), 4) = 2"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per generator match: doc_id, text_key, gen, kind, base, start, stop, match, before, after."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    d = d.where(F.col("text").rlike(r"@|[0-9]|\x20at\x20|[\[(]at[\])]"))
    for i, (_, _, pattern) in enumerate(GENERATORS):
        d = d.withColumn(f"m{i}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    for i, (_, _, pattern) in enumerate(GENERATORS):
        d = d.withColumn(f"g{i}", F.when(F.size(f"m{i}") > 0, F.split("text", pattern, -1)))
    # Lengths and short contexts of the gaps between matches, never the gaps themselves, are carried per match.
    found = F.array(*[F.expr(
        f"""if(size(m{i}) > 0, transform(sequence(0, size(m{i}) - 1), j -> named_struct('gen', {i}, 'j', j,
            'match', get(m{i}, j), 'gap', length(get(g{i}, j)), 'before', right(get(g{i}, j), {CONTEXT}),
            'after', left(get(g{i}, j + 1), {CONTEXT}))), array())""") for i in range(len(GENERATORS))])
    # The outer form: a plain explode implies a filter on its size, which would be pushed below the match
    # columns and run the patterns again inside the lambdas.
    c = d.select("doc_id", "text_key", F.explode_outer(F.flatten(found)).alias("c")).where("c is not null").select("doc_id", "text_key", "c.*")
    n = c.sparkSession.conf.get("spark.sql.shuffle.partitions")
    c = c.repartition(int(n), "doc_id", "text_key").dropDuplicates(["doc_id", "text_key", "gen", "j"])
    w = Window.partitionBy("doc_id", "text_key", "gen").orderBy("j")
    size = F.length("match")
    start = F.sum(F.col("gap") + size).over(w) - size
    kind = F.element_at(F.array(*[F.lit(k) for k, _, _ in GENERATORS]), F.col("gen") + 1)
    base = F.element_at(F.array(*[F.lit(b) for _, b, _ in GENERATORS]), F.col("gen") + 1)
    return c.select("doc_id", "text_key", "gen", kind.alias("kind"), base.alias("base"), start.alias("start"),
                    (start + size).alias("stop"), "match", "before", "after")


def _luhn(digits):
    rev = F.split(F.reverse(digits), "")
    return F.aggregate(
        F.filter(rev, lambda d: d != ""), F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")),
        lambda a, d: F.struct(
            (a["s"] + F.when(a["i"] % 2 == 0, d.cast("int")).when(d.cast("int") > 4, 2 * d.cast("int") - 9)
             .otherwise(2 * d.cast("int"))).alias("s"), (a["i"] + 1).alias("i")),
        lambda a: a["s"] % 10 == 0)


def _checked(c: DataFrame) -> DataFrame:
    digits = F.regexp_replace("match", "[^0-9]", "")
    parts = F.filter(F.split("match", "[^0-9]+"), lambda p: p != "")
    small = F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                     & (F.coalesce(F.try_to_number(F.right(p, F.lit(3)), F.lit("999")).cast("int"), F.lit(0)) <= 255))
    c = c.withColumns({"digits": digits, "octets": (small & (F.size(parts) == 4)).cast("int")})
    n = F.length("digits")
    c = c.withColumn("luhn", F.when(n.between(13, 19), _luhn(F.col("digits"))).otherwise(F.lit(False)).cast("int"))
    valid = (F.when(F.col("kind") == "email", F.lit(True)).when(F.col("kind") == "ip", F.col("octets") == 1)
             .when(F.col("kind") == "card", n.between(14, 19) & (F.col("luhn") == 1)).otherwise(n.between(10, 15)))
    return c.withColumn("valid", F.col("base") & valid)


def _featured(c: DataFrame) -> DataFrame:
    def bucket(x, top):
        return F.least(x, F.lit(top))

    def side(ch):
        return (F.when(ch == "", 0).when(ch.rlike("[0-9]"), 1).when(ch.rlike(r"\p{L}"), 2).when(ch.rlike(r"\s"), 3)
                .when(ch.rlike("[.,;:!?]"), 4).otherwise(5))

    cue = F.lit(0)
    for k, words in CUES.items():
        cue = F.when((F.col("kind") == k) & F.lower("before").rlike(words), 1).otherwise(cue)
    n = F.length("match")
    letters = n - F.length(F.regexp_replace("match", "[A-Za-z]", ""))
    return c.withColumns({
        "n_digits": bucket(F.length("digits"), 24), "n_chars": bucket(n, 40), "n_letters": bucket(letters, 12),
        "n_seps": bucket(n - letters - F.length("digits"), 8), "plus": F.contains("match", F.lit("+")).cast("int"),
        "paren": F.contains("match", F.lit("(")).cast("int"), "left": side(F.right("before", F.lit(1))),
        "right": side(F.left("after", F.lit(1))), "cue": cue,
        "spelled": bucket(F.regexp_count("match", F.lit(r"[\x20\[(](?:at|dot)[\x20\])]")), 4),
        "sort": F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")})


def _labelled(c: DataFrame) -> DataFrame:
    """Adds ``near`` (overlaps a valid base span) and ``label``.

    1: equals a valid base span; 0: a base match that failed, or overlaps a valid span without
    lying inside one of its own kind; null: nothing is known.
    """
    key = ["doc_id", "text_key"]
    ok = F.col("valid")
    before = Window.partitionBy(*key).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*key).orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    own = Window.partitionBy(*key, "kind").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*key, "start", "stop", "kind")
    stop = F.when(ok, F.col("stop"))
    c = c.withColumns({"reach": F.max(stop).over(before), "next": F.min(F.when(ok, F.col("start"))).over(after),
                       "hit": F.max(ok).over(same), "part": F.coalesce(F.max(stop).over(own) >= F.col("stop"), F.lit(False))})
    near = (F.coalesce("reach", F.lit(-1)) > F.col("start")) | (F.coalesce("next", F.col("stop")) < F.col("stop"))
    label = F.when(F.col("hit"), 1).when((near | F.col("base")) & ~F.col("part"), 0)
    return c.withColumns({"near": near, "label": label})


def _masked(c: DataFrame) -> DataFrame:
    """Valid base spans rewritten into the forms that only the wide generators propose: further positive examples.

    A phone loses its country code (as written, with plain hyphens, and with a trunk zero); an address is
    spelled out in words, in brackets, or with a bracketed sign alone.  Forms that no wide generator matches go.
    """
    m = F.col("match")
    tail = F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]?", "")
    digits = F.regexp_replace(tail, "[^0-9]", "")
    plain = F.regexp_replace(digits, "^([0-9]{3})([0-9]{3})([0-9]{4})$", "$1-$2-$3")
    trunk = F.regexp_replace(digits, "^([0-9]{2})([0-9]{4})([0-9]{4})$", "0$1 $2 $3")
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

    def spelt(at, dot):
        return F.concat(name, F.lit(at), F.replace(domain, F.lit("."), F.lit(dot)))

    forms = F.when(F.col("kind") == "phone", F.array(tail, plain, trunk)).when(F.col("kind") == "email", F.array(
        spelt(" at ", " dot "), spelt(" [at] ", " [dot] "), spelt("(at)", "(dot)"), spelt(" [at] ", ".")))
    wide = F.lit(False)
    for kind, base, pattern in GENERATORS:
        if not base and kind in ("phone", "email"):
            wide = wide | ((F.col("kind") == kind) & F.col("match").rlike(f"^(?:{pattern})$"))
    out = c.where("valid").select("doc_id", "kind", F.lit(False).alias("base"), F.explode(F.array_distinct(forms)).alias("match"), "before", "after")
    return _checked(out.where(wide)).withColumn("label", F.lit(1))


def _model(c: DataFrame):
    """(fitted trees, {kind: threshold}) or None when one of the classes is missing."""
    columns = ["doc_id", "kind", "label", *FEATURES]
    unknown = c.where("label is null and not near and not (kind = 'card' and luhn = 1) and not (kind = 'ip' and octets = 1)")
    rows = c.where("label is not null").select(*columns, F.lit(True).alias("known")).unionByName(
        _featured(_masked(c)).select(*columns, F.lit(True).alias("known"))).unionByName(
        unknown.withColumn("label", F.lit(0)).select(*columns, F.lit(False).alias("known")))
    cells = rows.withColumn("test", F.expr(TEST_FOLD)).groupBy("kind", "test", "known", "label", *FEATURES).agg(
        (F.count(F.lit(1)) * F.when(F.col("known"), 1.0).otherwise(UNKNOWN)).alias("weight"))
    # One row per combination of the bounded features: small, so one sorted partition makes the fit repeatable.
    cells = cut_table(cells, "pii-cells").coalesce(1)
    seen = {(r[0], r[1]) for r in cells.select("test", "label").distinct().collect()}
    if not {(False, 0), (False, 1)} <= seen:
        return None
    put = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fit = put.transform(cells.where("not test").orderBy("kind", "known", "label", *FEATURES))
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, minWeightFractionPerNode=LEAF_SHARE, seed=7).fit(fit)
    scored = model.transform(put.transform(cells.where("test and known"))).select(
        "kind", "label", "weight", vector_to_array("probability")[1].alias("p"))
    steps = F.explode(F.array(*[F.lit(x / 20) for x in range(10, 20)]))
    table = scored.withColumn("t", steps).where("p >= t").groupBy("kind", "t").agg(
        F.sum(F.col("weight") * F.col("label")).alias("good"), F.sum("weight").alias("all")).collect()
    limits: dict[str, float] = {}
    for kind, t, good, every in sorted(table, key=lambda r: -r[1]):
        if good >= MIN_PRECISION * every:
            limits[kind] = t
        elif kind in limits:
            break
    return (put, model, limits) if limits else None


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, kind, start, stop, base, score): redactions, base spans first in rank."""
    c = cut_table(_labelled(_checked(candidates(docs, doc_id, text))), "pii")
    c = _featured(c)
    keep = ["doc_id", "text_key", "kind", "start", "stop", "base"]
    base = c.where("valid").select(*keep, F.lit(1.0).alias("score"))
    fitted = _model(c)
    if fitted is None:
        return base
    put, model, limits = fitted
    rest = c.where("label is null and not near")
    rest = model.transform(put.transform(rest)).select(*keep, vector_to_array("probability")[1].alias("score"))
    limit = F.lit(2.0)
    for k, t in limits.items():
        limit = F.when(F.col("kind") == k, t).otherwise(limit)
    rest = rest.where(F.col("score") >= limit)
    rest = rest.groupBy(*keep).agg(F.max("score").alias("score"))
    # A candidate inside an accepted one of its kind goes; the others are taken by score within each run of overlaps.
    own = Window.partitionBy("doc_id", "text_key", "kind").orderBy("start", F.col("stop").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("reach", F.max("stop").over(own)).where("reach is null or reach < stop").drop("reach")
    w = Window.partitionBy("doc_id", "text_key").orderBy("start", F.col("stop").desc(), "kind")
    rest = rest.withColumn("reach", F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rest = rest.withColumn("run", F.sum(F.when(F.col("reach") > F.col("start"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    item = F.struct((-F.round("score", 6)).alias("rank"), "start", (-F.col("stop")).alias("back"), "kind", "stop", "base", "score")
    runs = rest.groupBy("doc_id", "text_key", "run").agg(F.sort_array(F.collect_list(item)).alias("all"))
    taken = F.expr("""aggregate(slice(all, 2, size(all)), slice(all, 1, 1), (kept, x) ->
        if(exists(kept, k -> k.start < x.stop and x.start < k.stop), kept, concat(kept, array(x))))""")
    rest = runs.select("doc_id", "text_key", F.explode(taken).alias("s")).select("doc_id", "text_key", "s.*").select(*keep, "score")
    return base.unionByName(rest)


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, text, found (sorted spans), and n_<kind> (long) of its base spans."""
    s = find_spans(docs, doc_id, text)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    item = F.struct(F.col("start").cast("long").alias("start"), order.alias("rank"), "kind",
                    F.col("stop").cast("long").alias("stop"), "base", "score")
    s = s.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(item)).alias("found"))
    s = cut_table(s.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"}), "pii-spans")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    d = d.join(s, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    counts = [F.coalesce(F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == k))), F.lit(0)).cast("long").alias(f"n_{k}")
              for k in KINDS]
    counts = [F.when(F.col("found").isNull(), F.lit(0).cast("long")).otherwise(c).alias(f"n_{k}") for k, c in zip(KINDS, counts)]
    return d.select("doc_id", "text", "found", *counts)


def spelled(found, only_base: bool = False):
    """``kind:start:end`` items joined by commas; empty without spans."""
    f = F.filter(found, lambda x: x["base"]) if only_base else found
    items = F.transform(f, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")))
    return F.coalesce(F.array_join(items, ","), F.lit(""))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with each redaction replaced by its kind in brackets; overlapping spans give the first one's label."""
    r = pii_report(docs, doc_id, text)
    cut = F.expr("""aggregate(found, struct('' as out, 1 as at), (a, s) -> if(s.stop < a.at, a, struct(
        concat(a.out, substring(text, a.at, greatest(cast(s.start as int) + 1 - a.at, 0)),
               if(s.start + 1 >= a.at, concat('[', upper(s.kind), ']'), '')) as out,
        greatest(cast(s.stop as int) + 1, a.at) as at)), a -> concat(a.out, substring(text, a.at)))""")
    return r.select("doc_id", F.when(F.col("found").isNull(), F.col("text")).otherwise(cut).alias("text"))
