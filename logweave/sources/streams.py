"""Line sources, bounded and streaming (SRC1-SRC10).

Every source yields a frame with a ``value: string`` column (plus source
metadata), which is what all parsing operators take.  Connectors that are not
shipped with Spark (Kafka, Kinesis) are plain ``format(...)`` loaders: they work
when the connector jar is on the cluster's classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.operators.parse import decode_payload


# ---------------------------------------------------------------- bounded text (SRC5)
def text_file(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: lines of a text file or folder."""
    return spark.read.text(path)


# ---------------------------------------------------------------- streaming text (SRC1, SRC6)
def socket_lines(spark: SparkSession, host: str = "127.0.0.1", port: int = 9999) -> DataFrame:
    """SRC1: newline-delimited text from a TCP socket (no replay: tests use ``text_dir_stream``)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def text_dir_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    glob: str | None = None) -> DataFrame:
    """SRC6: new text files in a folder as a stream of lines."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(path)


# ---------------------------------------------------------------- brokers (SRC3, SRC4, P14)
def kafka_lines(spark: SparkSession, bootstrap: str, topics, starting_offsets: str = "earliest") -> DataFrame:
    """SRC3: Kafka topic(s) from the earliest offset; value as string.  Offsets live in the
    query checkpoint, so nothing is committed to Kafka (the reference disables auto commit)."""
    topics = ",".join(topics) if not isinstance(topics, str) else topics
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topics).option("startingOffsets", starting_offsets).load())
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")


def broker_lines(spark: SparkSession, fmt: str, options: dict, payload: str = "data") -> DataFrame:
    """SRC4 (Kinesis and similar): any streaming connector whose records carry a byte payload;
    the payload is decoded to ``value`` (P14)."""
    raw = spark.readStream.format(fmt).options(**options).load()
    return decode_payload(raw, body=payload, keep=[c for c in raw.columns if c != payload])


# ---------------------------------------------------------------- archive replay (SRC7)
def archive_batches(spark: SparkSession, root: str, dir_glob: str = "Tweets_*", file_glob: str = "part-*") -> DataFrame:
    """SRC7 (batch form): archived text files ``root/<dir_glob>/<file_glob>`` with a ``batch``
    number that follows (directory, file) name order; empty files give no batch.
    ``sources.archive.replay`` is the stream form."""
    df = (spark.read.option("pathGlobFilter", file_glob).text(f"{root.rstrip('/')}/{dir_glob}")
          .select("value", F.col("_metadata.file_path").alias("file")))
    from logweave.operators.ordered import global_index
    files = global_index(df.select("file").distinct(), ["file"], "batch").withColumn("batch", F.col("batch").cast("int"))
    return df.join(files, "file")


# ---------------------------------------------------------------- JSON responses (SRC8)
RESPONSE_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(
    T.StructType([T.StructField("text", T.StringType())])))])


def response_texts(responses: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """SRC8: ``{"data": [{"text": ...}, ...]}`` -> one row per item; a missing text is '';
    invalid JSON or a missing ``data`` gives no rows."""
    parsed = responses.select(*keep, F.from_json(F.col(value), RESPONSE_SCHEMA,
                                                 {"mode": "PERMISSIVE"}).alias("_r"))
    return parsed.select(*keep, F.posexplode("_r.data").alias("item_pos", "_item")).select(
        *keep, "item_pos", F.coalesce(F.col("_item.text"), F.lit("")).alias("text"))


# ---------------------------------------------------------------- vectors (SRC9)
def parse_vector(value) -> F.Column:
    """'[a,b,...]' -> array<double>."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v, "array<double>")


def parse_labeled_point(value) -> F.Column:
    """'(label,[a,b,...])' or 'label,a b ...' -> struct<label double, features array<double>>."""
    v = F.col(value) if isinstance(value, str) else value
    paren = v.startswith("(")
    lab_p = F.regexp_extract(v, r"^\(\s*([^,]+)\s*,", 1)
    vec_p = F.regexp_extract(v, r"\[(.*)\]", 1)
    lab_c = F.substring_index(v, ",", 1)
    vec_c = F.trim(F.substring(v, F.length(lab_c) + 2, 1 << 30))
    feats = F.when(paren, F.split(vec_p, r"\s*,\s*")).otherwise(F.split(vec_c, r"\s+"))
    return F.struct(F.when(paren, lab_p).otherwise(lab_c).try_cast("double").alias("label"),
                    feats.try_cast("array<double>").alias("features"))


# ---------------------------------------------------------------- delimited tables (SRC10)
RATINGS_SCHEMA = "user long, item long, rating int, ts long"
USERS_SCHEMA = "id long, age int, gender string, occupation string, zip string"
GENRES_SCHEMA = "name string, id int"


def ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=RATINGS_SCHEMA)


def users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="|", schema=USERS_SCHEMA)


def genres(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated (name, id); the trailing blank line is dropped."""
    return spark.read.csv(path, sep="|", schema=GENRES_SCHEMA).where(F.col("name").isNotNull())
