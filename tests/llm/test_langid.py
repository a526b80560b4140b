import base64
import random
import zlib

import duckdb

from logweave.llm import langid
from logweave.llm.queries import op1_langid
from tests.llm.support import DOCS, docs_frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM read_parquet('{SF}/documents.parquet')").fetchall())
    text = dict(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall())
    rows = op1_langid(spark, SF).collect()
    assert len(rows) == len(truth)
    langs = {x for x in truth.values() if x is not None}
    good = n = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        letter = any(c.isalpha() for c in text[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not letter) and (not letter or r.lang_pred in langs)
        assert letter or r.rejected
        if r.held_out and letter and truth[r.doc_id] is not None:
            n += 1
            good += r.lang_pred == truth[r.doc_id]
    assert n > 100 and good / n >= 0.97
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_rejects_foreign_texts_and_bears_edge_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(langid.training_fold(docs))
    odd = spark.createDataFrame([(1, "Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше в лес"),
                                 (2, "12345 !!! ***"), (3, "素早い茶色の狐はのろまな犬を飛び越える")], "doc_id long, text string")
    assert all(r.rejected for r in langid.classify(odd, model).collect())
    df = docs_frame(spark)
    got = langid.classify(df, model).collect()
    assert len(got) == len(DOCS) and sum(r.lang_pred == "und" for r in got) == 4
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns and 0 < kept.count() <= len(DOCS) - 4
    assert langid.train(df.limit(0)) is None and langid.classify(df, None).where("lang_pred != 'und'").isEmpty()
    assert langid.train(df) is not None


def test_rejects_long_foreign_texts_and_keeps_short_clean_ones(spark):
    rnd = random.Random(5)

    def words(letters, n):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))) for _ in range(n))

    polish = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem "
              "i sumieniem i powinni postępować wobec innych w duchu braterstwa. ")
    turkish = ("Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve "
               "birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. ")
    odd = [words("абвгдежзийклмнопрстуфхцчшщъыьэюя", 2000), "".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(5000)),
           words("abcdefghijklmnopqrstuvwxyz", 60), base64.b64encode(rnd.randbytes(2250)).decode(), polish, polish * 8, turkish,
           turkish * 8, "asdf jkl qwer uiop zxcv asdfgh lkjh poiu mnbv fghj dfgh"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(langid.training_fold(docs))
    got = langid.classify(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), model).collect()
    assert [r.doc_id for r in got if not r.rejected] == []
    clean = docs.where(langid.held_out()).where("text rlike '[a-z]'")
    for size in (10, 30, 100, 300, 3000):
        cut = langid.classify(clean.selectExpr("doc_id", f"left(text, {size}) AS text"), model).collect()
        assert sum(r.rejected for r in cut) <= 0.02 * len(cut), size
