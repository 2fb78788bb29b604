"""The registered queries of this subpackage, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import licenses, line_dedup, vector_codes
from .common import table


def _public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark, sf_dir):
    from . import secrets

    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op3_surrogates(spark, sf_dir):
    from . import surrogates

    found = surrogates.replace(table(spark, sf_dir, "documents"), b"key of this query; a real one is kept secret")
    return found.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.array_join(F.transform(
        "entities", lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["stop"].cast("string"))), ",").alias("spans"))


def op4_class_lm(spark, sf_dir):
    from . import class_lm

    return class_lm.score(table(spark, sf_dir, "documents"))


def op5_bottom_k(spark, sf_dir):
    from . import sketch

    found = sketch.edited_likeness(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
                        sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                        "near_edited", "near_next", "shingles", "held")


def op6_packing(spark, sf_dir):
    from . import packing

    packed = packing.pack(table(spark, sf_dir, "documents"), _public("word_bpe_49k.json"), with_ids=False,
                          kept=700_000)
    return packed.drop("ids")


def op7_embedding_near_dedup(spark, sf_dir):
    from . import vector_cells

    return vector_cells.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_simhash_near_dedup(spark, sf_dir):
    from . import simhash

    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality(spark, sf_dir):
    from . import quality

    return quality.classify(table(spark, sf_dir, "documents"))


def op10_pieces(spark, sf_dir):
    from . import pieces

    return pieces.digest(pieces.encode(table(spark, sf_dir, "documents"), _public("piece_bpe_32k.model")))


def op11_conversation_repair(spark, sf_dir):
    from . import repair

    return repair.digest(repair.damage(table(spark, sf_dir, "conversations")))


def op12_license_scan(spark, sf_dir):
    return licenses.digest(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_line_dedup, op3_surrogates, op4_class_lm, op5_bottom_k, op6_packing, op7_embedding_near_dedup, op8_simhash_near_dedup, op9_quality, op10_pieces,
    op11_conversation_repair, op12_license_scan, op13_vector_codes)}
ORACLES: dict[str, str] = {"op2_line_dedup": line_dedup.SQL, "op12_license_scan": licenses.SQL,
                           "op13_vector_codes": vector_codes.SQL}
