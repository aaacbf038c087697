"""Queries p3 to p8 over the test tables, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import addresses, bpe, language, leakage, names
from . import survivors as best

EXPORT_DAY = "2026-06-30"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _named(spark: SparkSession, sf_dir: str) -> names.Tables:
    applicants, people = table(spark, sf_dir, "cn_stage_applicant"), table(spark, sf_dir, "person")
    return {"cn_stage_applicant": (applicants, "row_id", "raw_name", "company", "raw_address"), "person": (people, "row_id", "normalized_name", "person", None)}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that name one company or one person in different texts."""
    return names.same_names(_named(spark, sf_dir))


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company or person of each row, with its number of links."""
    return names.named_entities(_named(spark, sf_dir))


def _addressed(spark: SparkSession, sf_dir: str) -> tuple[addresses.Tables, DataFrame, str]:
    applicants, people = table(spark, sf_dir, "cn_stage_applicant"), table(spark, sf_dir, "person")
    return {"cn_stage_applicant": (applicants, "row_id", "raw_address"), "person": (people, "row_id", "canonical_name")}, applicants, "city"


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that give one place in different texts."""
    return addresses.same_places(*_addressed(spark, sf_dir))


def p4_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row that shares it with another text, with its number of links."""
    return addresses.placed_rows(*_addressed(spark, sf_dir))


def _grouped_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = best.duplicate_groups(table(spark, sf_dir, "entity_merge_decision"))
    rows = best.measured(table(spark, sf_dir, "entity_identifier"), EXPORT_DAY)
    return rows.join(groups.withColumnRenamed("entity_id", "entity"), "entity")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving identifier row of each group of duplicate entities and identifier type."""
    return best.survivors(_grouped_identifiers(spark, sf_dir), ["group_id", "identifier_type"])


def p5_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving rows with their fields, nulls filled from the next dominance layers."""
    return best.survivor_records(_grouped_identifiers(spark, sf_dir), ["group_id", "identifier_type"], ["identifier_value", "normalized_value", "country_code", "source"])


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document by byte_bpe_50k; the vocabulary's path is a setting of the session."""
    path = spark.conf.get("spark.marlstone.vocabulary", VOCABULARY)
    return bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text", path)


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, tokens and characters by kind of document."""
    kinds = table(spark, sf_dir, "documents").select("doc_id", "doc_kind", "n_chars")
    return p6_ids(spark, sf_dir).join(kinds, "doc_id").groupBy("doc_kind").agg(F.count("*").alias("documents"), F.sum(F.size("ids")).alias("tokens"), F.sum("n_chars").alias("chars"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item's words."""
    return p7_coverage(spark, sf_dir).select("doc_id", "item_id")


def p7_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p7_found with the share of the item's words that the document holds."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the documents with a missing or wrong label or with more than one language."""
    return p8_confidence(spark, sf_dir).select("doc_id", "lang")


def p8_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p8_found with the confidence of each language."""
    documents = table(spark, sf_dir, "documents")
    model = language.fitted(documents, "doc_id", "text", "lang")
    return language.wrong_or_mixed(documents, "doc_id", "text", "lang", model)


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of one language of every document with its place, language and confidence."""
    documents = table(spark, sf_dir, "documents")
    return language.passages(documents, "doc_id", "text", language.fitted(documents, "doc_id", "text", "lang"))


QUERIES = {
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p4_found": p4_found,
    "p4_places": p4_places,
    "p5_found": p5_found,
    "p5_survivors": p5_survivors,
    "p6_ids": p6_ids,
    "p6_counts": p6_counts,
    "p7_found": p7_found,
    "p7_coverage": p7_coverage,
    "p8_found": p8_found,
    "p8_confidence": p8_confidence,
    "p8_passages": p8_passages,
}

_GROUPS = r"""
WITH RECURSIVE decision AS (
  SELECT lower(canonical_entity_id) AS c, lower(duplicate_entity_id) AS d, decision_status, coalesce(evidence, '') AS evidence,
    created_at = max(created_at) OVER (PARTITION BY lower(canonical_entity_id), lower(duplicate_entity_id)) AS in_force
  FROM entity_merge_decision),
force AS (SELECT * FROM decision WHERE in_force AND decision_status <> 'BLOCKED'),
pair AS (
  SELECT c AS a, d AS b FROM force
  UNION SELECT c, lower(unnest(regexp_extract_all(regexp_extract(evidence, '(?is)member(s|_?ids)[\\"''\s]*[:=][\\"''\s\[(]*([^\])}:=]*)', 2),
    '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}'))) FROM force),
edge AS (SELECT a, b FROM pair UNION SELECT b, a FROM pair UNION SELECT a, a FROM pair UNION SELECT b, b FROM pair),
reach(node, root) AS (SELECT a, a FROM edge UNION SELECT e.b, r.root FROM reach r JOIN edge e ON e.a = r.node),
member AS (SELECT node AS entity_id, min(root) AS group_id FROM reach GROUP BY 1)"""
_KNOWN = "CASE WHEN trim({0}) <> '' AND lower(trim({0})) NOT IN ('-', '--', '无', 'n/a', '—', '暂无', 'none', 'null', '/', '不详') AND NOT contains({0}, '*') THEN {0} END"
_TRUST = "round(CASE WHEN confidence_score > 1 THEN confidence_score / 100 ELSE confidence_score END, 4)"
_SEEN = "CASE WHEN last_seen_at < first_seen_at OR last_seen_at >= TIMESTAMP '2026-07-01' THEN NULL ELSE last_seen_at END"
_P5 = f"""{_GROUPS},
scored AS (
  SELECT m.group_id, i.identifier_type, i.row_id, {_TRUST} AS trust, {_SEEN} AS seen
  FROM entity_identifier i JOIN member m ON lower(i.entity_id) = m.entity_id
  WHERE {_KNOWN.format("i.identifier_value")} IS NOT NULL)
SELECT group_id, identifier_type, row_id FROM scored
QUALIFY row_number() OVER (PARTITION BY group_id, identifier_type ORDER BY trust DESC NULLS LAST, seen DESC NULLS LAST, row_id) = 1
"""
_FIELDS = ("identifier_value", "normalized_value", "country_code", "source")
# layers by the longest chain of dominating cells; a null measure is the least
_P5_SURVIVORS = f"""{_GROUPS},
known AS (
  SELECT m.group_id, i.identifier_type, i.row_id, coalesce({_TRUST}, -1) AS trust, coalesce({_SEEN}, TIMESTAMP '0001-01-01') AS seen, {", ".join(f"{_KNOWN.format('i.' + f)} AS {f}" for f in _FIELDS)}
  FROM entity_identifier i JOIN member m ON lower(i.entity_id) = m.entity_id),
record AS (SELECT *, CASE WHEN identifier_value IS NULL THEN 0 ELSE 1 + {" + ".join(f"({f} IS NOT NULL)::int" for f in _FIELDS)} END AS complete FROM known),
cell AS (SELECT DISTINCT group_id, identifier_type, complete, trust, seen FROM record),
below AS (
  SELECT a AS upper, b AS lower FROM cell a JOIN cell b ON a.group_id = b.group_id AND a.identifier_type = b.identifier_type
    AND a.complete >= b.complete AND a.trust >= b.trust AND a.seen >= b.seen AND a <> b),
depth(cell, n) AS (SELECT cell, 1 FROM cell UNION SELECT b.lower, n + 1 FROM depth d JOIN below b ON d.cell = b.upper),
layer AS (SELECT cell.group_id AS group_id, cell.identifier_type AS identifier_type, cell.complete AS complete, cell.trust AS trust, cell.seen AS seen, max(n) AS layer FROM depth GROUP BY cell),
placed AS (SELECT * FROM record JOIN layer USING (group_id, identifier_type, complete, trust, seen)),
best AS (SELECT * FROM placed WHERE complete > 0 QUALIFY row_number() OVER (PARTITION BY group_id, identifier_type ORDER BY trust DESC, seen DESC, row_id) = 1),
filled AS (
  SELECT group_id, identifier_type, {", ".join(f"arg_min({f}, (layer, complete = 0, -trust, -epoch_us(seen), row_id)) FILTER ({f} IS NOT NULL) AS {f}" for f in _FIELDS)} FROM placed GROUP BY ALL)
SELECT b.group_id, b.identifier_type, b.row_id, {", ".join(f"coalesce(b.{f}, f.{f}) AS {f}" for f in _FIELDS)} FROM best b JOIN filled f USING (group_id, identifier_type)
"""

ORACLE = {"p5_found": _P5, "p5_survivors": _P5_SURVIVORS}
