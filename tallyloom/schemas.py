"""Struct types of the project-history tables (one ``repo`` key on each)."""

from pyspark.sql.types import (ArrayType, DateType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, IntegerType)

S, L = StringType(), LongType()
TRIPWIRE = StructType([StructField("action", S), StructField("warning", S)])

ISSUES = StructType([
    StructField("repo", S), StructField("number", L), StructField("title", S),
    StructField("body", S), StructField("state", S), StructField("created_at", TimestampNTZType()),
    StructField("labels", ArrayType(S)), StructField("url", S)])

PULL_REQUESTS = StructType([
    StructField("repo", S), StructField("number", L), StructField("head_ref", S),
    StructField("body", S), StructField("title", S), StructField("diff", S), StructField("state", S)])

CLOSE_EVENTS = StructType([
    StructField("repo", S), StructField("issue", L), StructField("closed_at", TimestampNTZType()),
    StructField("seq", IntegerType()), StructField("closer_type", S), StructField("pr_number", L),
    StructField("pr_state", S), StructField("actor", L), StructField("closer_id", L)])

COMMENTS = StructType([
    StructField("repo", S), StructField("issue", L), StructField("seq", L), StructField("body", S)])

NODES = StructType([
    StructField("repo", S), StructField("objective", L), StructField("pos", L),
    StructField("node_id", S), StructField("description", S), StructField("status", S),
    StructField("plan_issue", L), StructField("pr_url", S), StructField("depends_on", ArrayType(S))])

# Node state as stored in the JSON blob (field names of the blob).
NODE_STATE = StructType([
    StructField("id", S), StructField("description", S), StructField("status", S),
    StructField("plan_issue", L), StructField("pr_url", S), StructField("depends_on", ArrayType(S))])

NOTES = StructType([
    StructField("repo", S), StructField("category", S), StructField("slug", S),
    StructField("title", S), StructField("read_when", ArrayType(S)),
    StructField("tripwires", ArrayType(TRIPWIRE)), StructField("last_updated", DateType()),
    StructField("source_issues", ArrayType(L)), StructField("body", S)])

LEARNING_ITEM = StructType([
    StructField("category", S), StructField("slug", S), StructField("title", S),
    StructField("read_when", ArrayType(S)), StructField("tripwires", ArrayType(TRIPWIRE)),
    StructField("body", S)])

AUDIT_ACTION = StructType([
    StructField("action", S), StructField("category", S), StructField("slug", S),
    StructField("reason", S), StructField("target_category", S), StructField("target_slug", S),
    StructField("target_updated_body", S)])
