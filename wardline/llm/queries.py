"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.llm import (exact, extract, infill, jaccard, langid, mix, neardup, pack, passages, shard, simhash, suffix,
                          whiten)


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shard(spark, sf_dir):
    return shard.shard(_table(spark, sf_dir, "documents"))


def op2_pack(spark, sf_dir):
    return pack.pack(_table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")


def op3_language(spark, sf_dir):
    return langid.languages(_table(spark, sf_dir, "documents"))


def op4_passages(spark, sf_dir):
    return passages.repeated(_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark, sf_dir):
    return neardup.link(_table(spark, sf_dir, "documents")).drop("digest", "stays")


def op6_suffix_dedup(spark, sf_dir):
    return suffix.strip_repeats(_table(spark, sf_dir, "documents"))


def op7_extract(spark, sf_dir):
    return extract.extract(_table(spark, sf_dir, "pages"))


def op8_mix(spark, sf_dir):
    return mix.taken(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark, sf_dir):
    return exact.dedup(_table(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    return simhash.fingerprints(_table(spark, sf_dir, "documents"))


def op11_infill(spark, sf_dir):
    rows = infill.infill(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_jaccard_join(spark, sf_dir):
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    rows = whiten.whitened(_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_shard": op1_shard,
    "op2_pack": op2_pack,
    "op3_language": op3_language,
    "op4_passages": op4_passages,
    "op5_near_dedup": op5_near_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_extract": op7_extract,
    "op8_mix": op8_mix,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_simhash": op10_simhash,
    "op11_infill": op11_infill,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_whitening": op13_whitening,
}

_LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz')")

ORACLES = {
    "op9_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)""",
    "op11_infill": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
      ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
      ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, l, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a,
      greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
           WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(l[1:a], ''), '') AS pre,
      coalesce(array_to_string(l[a + 1:b], ''), '') AS mid, coalesce(array_to_string(l[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
}
