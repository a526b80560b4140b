"""Queries of the training-data operators over the test tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweave.llm import (chat_format, collocations, decontaminate, embed_dedup, filter_audit, html_extract, langid, line_dedup,
                          mixing, ngram_join, pii, suffix_dedup, warc)
from logweave.llm.common import new_path, read


def op1_langid(spark, sf_dir):
    """Predicted language of every document; one fold in four is held out of the training."""
    docs = read(spark, sf_dir, "documents")
    model = langid.train(langid.training_fold(docs))
    out = langid.classify(docs, model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_warc(spark, sf_dir):
    """Write a content-addressed archive of every page, then read it back."""
    path = new_path(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark, sf_dir):
    """Personal data spans of every document."""
    r = pii.pii_report(read(spark, sf_dir, "documents"))
    return r.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(pii.spelled("found", only_base=True), 256).alias("base_sha256"),
                    pii.spelled("found").alias("spans"))


def op4_decontaminate(spark, sf_dir):
    """Words of each document covered by a 10-word window of a benchmark item."""
    out = decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_html(spark, sf_dir):
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op6_suffix_dedup(spark, sf_dir):
    """Bytes of every document outside 200-byte strings that also start elsewhere."""
    out = suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_ngram_join(spark, sf_dir):
    """Components of documents whose word 5-gram sets have a Jaccard similarity of 0.8 or more."""
    out = ngram_join.jaccard_classes(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op8_embeddings(spark, sf_dir):
    """Links, components and representatives of embeddings with a cosine of 0.9 or more."""
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_mixing(spark, sf_dir):
    """Words taken from every document by the mixture to target weights."""
    p = mixing.mix_plan(read(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_line_dedup(spark, sf_dir):
    """Lines of each document without those that match an earlier line of the corpus (token Jaccard >= 0.8)."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def chat_records(conv):
    """Stand-in input: every conversation as one JSON record, in one of the layouts that can hold its roles.

    Rows go by turn (ties by role and text, nulls first); null texts and roles are empty.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    plain = "forall(t, x -> x.role in ('user', 'assistant', 'system'))"
    pair = "size(t) = 2 and t[0].role = 'user' and t[1].role = 'assistant'"
    return c.selectExpr("conv_id", f"""case
        when pmod(conv_id, 5) = 1 and {plain} then to_json(struct(transform(t, x -> struct(
            case x.role when 'user' then 'human' when 'assistant' then 'gpt' else x.role end as `from`, x.text as value)) as conversations))
        when pmod(conv_id, 5) = 2 then to_json(struct(struct(transform(t, x -> struct(
            struct(x.role as name) as speaker, struct(x.text as text) as utterance)) as turns) as dialogue))
        when pmod(conv_id, 5) = 3 and {pair} then to_json(struct(t[0].text as prompt, t[1].text as completion))
        when pmod(conv_id, 5) = 4 and {pair} then to_json(struct(t[0].text as instruction, t[1].text as output))
        else to_json(struct(transform(t, x -> struct(x.role as role, x.text as content)) as messages)) end as record""")


def op11_chat_format(spark, sf_dir):
    """Every conversation (and one of control strings) formatted, then read back from the formatted text."""
    conv = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], conv.schema)
    out = chat_format.format_records(chat_records(conv.unionAll(more)))
    back = chat_format.read_back(out.select("conv_id", "formatted", "loss"))
    spelled = F.expr("array_join(transform(read_turns, x -> concat(x.role, '\n', x.text, '\n')), '')")
    return back.select("conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op12_collocations(spark, sf_dir):
    """Best collocations of two and three words of every language of the documents."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_filter_audit(spark, sf_dir):
    """Five filters over every document: what each removes in every order, and its Shapley value, per source."""
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_langid, op2_warc, op3_pii, op4_decontaminate, op5_html, op6_suffix_dedup, op7_ngram_join,
                                   op8_embeddings, op9_mixing, op10_line_dedup, op11_chat_format, op12_collocations, op13_filter_audit)}
