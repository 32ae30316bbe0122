"""The queries of this package, for __spark_entry__."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.llm import abuse, addresses, bpe, language, mainbody, matching, packing
from tamis.session import table


def p6_ids(spark, sf_dir):
    """doc_id and byte_bpe_50k ids of every document."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def p6_decoded(spark, sf_dir):
    """doc_id and the text that its ids decode to."""
    return bpe.decoded_documents(table(spark, sf_dir, "documents"))


def _packed(spark, sf_dir):
    return packing.pack_items(packing.sized_documents(table(spark, sf_dir, "documents")), packing.read_specs(table(spark, sf_dir, "container_specs")))


def p7_containers(spark, sf_dir):
    """Container of every piece of every non-empty document, for each spec."""
    return _packed(spark, sf_dir)[0]


def p7_summary(spark, sf_dir):
    """Containers used, the least possible number, bucket bounds and padding of each spec."""
    return _packed(spark, sf_dir)[1]


def p7_audit(spark, sf_dir):
    """For each spec: documents placed, pieces of documents split for no need or placed twice, and containers above capacity."""
    specs = table(spark, sf_dir, "container_specs")
    assignment, report = _packed(spark, sf_dir)
    by_doc = assignment.groupBy("spec_id", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces")).join(F.broadcast(report.select("spec_id", "capacity_tokens")), "spec_id")
    docs = by_doc.groupBy("spec_id").agg(F.count("*").alias("documents"), F.sum(F.when(F.col("pieces") != F.ceil(F.col("n") / F.col("capacity_tokens")), 1).otherwise(0)).alias("wrongly_split"))
    full = assignment.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(F.broadcast(report.select("spec_id", "capacity_tokens")), "spec_id")
    full = full.groupBy("spec_id").agg(F.sum(F.when(F.col("n") > F.col("capacity_tokens"), 1).otherwise(0)).alias("overfull"))
    counted = report.select("spec_id", (F.col("containers") <= F.ceil(F.col("least_possible") * 1.01) + 1).alias("within_a_hundredth"))
    return F.broadcast(specs.select("spec_id")).join(docs, "spec_id", "left").join(full, "spec_id", "left").join(counted, "spec_id", "left").select("spec_id", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("wrongly_split", F.lit(0)).alias("wrongly_split"), F.coalesce("overfull", F.lit(0)).alias("overfull"), "within_a_hundredth")


def p5_found(spark, sf_dir):
    """doc_id, lang of documents whose label is missing, wrong or not the only language."""
    return language.relabelled(table(spark, sf_dir, "documents"))


def p5_segments(spark, sf_dir):
    """Language and confidence of every segment of every document."""
    return language.language_segments(table(spark, sf_dir, "documents"))


def p8_found(spark, sf_dir):
    """doc_id, category of every category that a document contains."""
    return abuse.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_labels"))


def p8_scores(spark, sf_dir):
    """Score and flag of every document in every category."""
    return abuse.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_labels"))


def p8_source_rates(spark, sf_dir):
    """Share of flagged documents of every source."""
    return abuse.source_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_labels"))


def p2_found(spark, sf_dir):
    """page_id, line_no of the lines of every page's main body."""
    return mainbody.main_lines(table(spark, sf_dir, "captured_pages"))


def p2_host_paths(spark, sf_dir):
    """The container path that won on each host."""
    return mainbody.host_paths(mainbody.page_containers(table(spark, sf_dir, "captured_pages")))


def p3_found(spark, sf_dir):
    """store_id_a, store_id_b of all pairs of records of the same place."""
    return addresses.same_place(table(spark, sf_dir, "store_locations"))


def p3_places(spark, sf_dir):
    """The place of every record that can be placed."""
    return addresses.places(table(spark, sf_dir, "store_locations"))


def p4_found(spark, sf_dir):
    """entity_id, directory_id of the records of one firm."""
    return matching.found(table(spark, sf_dir, "entities"), table(spark, sf_dir, "roaster_directory"))


def p4_confidence(spark, sf_dir):
    """The confidence of every candidate pair."""
    return matching.matched(table(spark, sf_dir, "entities"), table(spark, sf_dir, "roaster_directory"))


_NAMES = (p2_found, p2_host_paths, p3_found, p3_places, p4_found, p4_confidence, p5_found, p5_segments, p6_ids, p6_decoded, p7_containers, p7_summary, p7_audit, p8_found, p8_scores, p8_source_rates)
QUERIES = {f.__name__: f for f in _NAMES}

#: What must hold of results that SQL can't compute itself: ids decode to the text, every text that isn't empty is placed once.
SQL: dict[str, str] = {
    "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p7_audit": """
        select s.spec_id, (select count(distinct d.doc_id) from documents d where length(d.text) > 0 and (s.doc_kind is null or d.kind = s.doc_kind)) as documents,
               0 as wrongly_split, 0 as overfull, true as within_a_hundredth
        from container_specs s""",
}
