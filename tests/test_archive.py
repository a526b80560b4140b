"""Archives: replay in name order across a restart, committed batches, repeated and failed batches."""

import io
import json
import os
import random
import tempfile

from conftest import rows
from pyspark.sql import functions as F

from logweave.sources import archive


def _dir():
    return tempfile.mkdtemp(prefix="logweave-test-")


def _write(root, folder, name, text, when):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with open(f"{root}/{folder}/{name}", "w", newline="") as f:
        f.write(text)
    os.utime(f"{root}/{folder}/{name}", (when, when))


def test_replay_in_name_order_after_a_restart(spark):
    """Folders 0 to 11 with shuffled file times; six are there at first, the others after a restart."""
    d, out = _dir(), []
    times = list(range(12))
    random.Random(4).shuffle(times)

    def run():
        q = (archive.replay(spark, d + "/in").writeStream.outputMode("append")
             .foreachBatch(lambda df, i: out.append([tuple(r) for r in df.orderBy("value").collect()]))
             .option("checkpointLocation", d + "/ck").trigger(processingTime="200 milliseconds").start())
        q.processAllAvailable()
        q.stop()

    for i in range(12):
        if i == 6:
            run()
            assert [b[0][1] for b in out if b] == [f"Tweets_{k}/part-00000" for k in range(6)]
        _write(d + "/in", f"Tweets_{i}", "part-00000", f"a{i:02d}\r\nb{i:02d}", 1_700_000_000 + times[i])
        _write(d + "/in", f"Tweets_{i}", "part-00001", "", 1_700_000_000)
        _write(d + "/in", f"Tweets_{i}", "notes", "not a part", 1_700_000_000)
    run()
    assert [b for b in out if b] == [[(f"{x}{i:02d}", f"Tweets_{i}/part-00000") for x in "ab"] for i in range(12)]


def test_lines_across_blocks():
    rnd = random.Random(1)
    text = b"".join(rnd.choice([b"ab", b"\n", b"\r\n", b"\r", b"\xc3\xa9"]) for _ in range(4000))
    want = text.decode().replace("\r\n", "\n").replace("\r", "\n").split("\n")
    want = want[:-1] if not want[-1] else want
    for block in (1, 2, 7, 100_000):
        archive._BLOCK, old = block, archive._BLOCK
        try:
            assert [x.decode() for x in archive.text_lines(io.BytesIO(text))] == want
        finally:
            archive._BLOCK = old


def test_batches_are_committed_once(spark):
    d = _dir()
    for i, n in enumerate([5, 0, 7]):
        spark.range(n).select(F.concat(F.lit(f"t{i}-"), F.col("id")).alias("text")).repartition(2 if n else 1).write.mode("append").parquet(f"{d}/in/{i}")

    def run(ck):
        src = spark.readStream.schema("text string").parquet(d + "/in/{0,1,2}")
        q = archive.text_batches(src, d + "/out").option("checkpointLocation", d + ck).trigger(availableNow=True).start()
        q.awaitTermination()

    run("/ck")
    folder = f"{d}/out/Tweets_0000000000"
    first = rows(spark.read.text(folder))
    assert len(first) == 12 and sorted(os.listdir(d + "/out")) == ["Tweets_0000000000", "_staging"]
    manifest = json.load(open(folder + "/_manifest.json"))
    assert manifest["rows"] == 12 and len(manifest["files"]) > 1 and os.listdir(d + "/out/_staging") == []
    run("/again")  # the same batch id runs again: one copy stays
    assert rows(spark.read.text(folder)) == first
    # A file that no manifest names is not replayed.
    _write(d + "/out", "Tweets_0000000000", "part-99999", "stray\n", 1)
    assert [f.split("/")[1] for f in archive.archive_files(d + "/out", "Tweets_*", "part-*")] == manifest["files"]


def test_abort_removes_what_was_written():
    d = _dir()
    w = archive._Batches({"path": d})
    os.makedirs(d + "/_staging")
    open(d + "/_staging/x", "w").close()
    w.abort([archive._Part("_staging/x", 0, 1), archive._Part("_staging/gone", 1, 1), archive._Part("", 2, 0), None], 3)
    assert os.listdir(d + "/_staging") == []
    w.commit([archive._Part("", 0, 0)], 4)
    assert os.listdir(d) == ["_staging"]
