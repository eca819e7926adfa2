"""Explicit schemas of the inputs; absent keys become null."""

from pyspark.sql import types as T

POSTING = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("posted_relative", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("contract_label", T.StringType()),
    T.StructField("applicants", T.IntegerType()),
    T.StructField("applicants_text", T.StringType()),
    T.StructField("closed", T.BooleanType()),
    T.StructField("reposted", T.BooleanType()),
    T.StructField("open_confirmed", T.BooleanType()),
    T.StructField("mission", T.StringType()),
    T.StructField("work_mode", T.StringType()),
    T.StructField("duration", T.StringType()),
])
# names of the same columns in cached postings on disk
POSTING_SOURCE_NAMES = {
    "poste": "title", "entite": "entity", "ville": "place", "date_pub": "published", "texte": "body",
    "emploi_label": "contract_label", "nb_candidats": "applicants", "nb_candidats_txt": "applicants_text",
    "cloturee": "closed", "republication": "reposted", "open_confirme": "open_confirmed",
    "lieu": "work_mode", "duree": "duration",
}
NOTICE = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("descriptors", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("codes", T.ArrayType(T.StringType())),
    T.StructField("framework", T.BooleanType()),
    T.StructField("amount", T.StringType()),
    T.StructField("amount_value", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("deposit", T.StringType()),
    T.StructField("procedure_type", T.StringType()),
    T.StructField("procedure_text", T.StringType()),
    T.StructField("market_type", T.ArrayType(T.StringType())),
    T.StructField("nature", T.StringType()),
    T.StructField("nature_text", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("deadline", T.StringType()),
    T.StructField("profile_link", T.StringType()),
    T.StructField("criteria", T.StringType()),
    T.StructField("duration", T.StringType()),
    T.StructField("notice_url", T.StringType()),
    T.StructField("file_link", T.StringType()),
])
FORECAST = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ministry", T.StringType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("funder", T.StringType()),
    T.StructField("market_type", T.ArrayType(T.StringType())),
    T.StructField("award_mode", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("amount_note", T.StringType()),
    T.StructField("notice_url", T.StringType()),
])
LEDGER = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_check", T.TimestampType()),
    T.StructField("verdict", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("entity", T.StringType()),
])
JUDGEMENT = T.StructType([
    T.StructField("content_hash", T.StringType()),
    T.StructField("rule_version", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("verdict", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("reason", T.StringType()),
])
PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
