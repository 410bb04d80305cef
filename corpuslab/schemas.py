"""Declared schemas as DDL text; no reader on the main path infers types."""

from __future__ import annotations

# Article states.
STATUS_SUCCESS = "success"
STATUS_NO_TEXT = "failed_no_text"
STATUS_UNKNOWN = "unknown"


def column_names(schema: str) -> list[str]:
    """Column names of a flat schema."""
    return [field.split()[0] for field in schema.split(",")]


ARTICLE = (
    "url string, title string, text string, source string, retrieved_at timestamp, status string, "
    "story_id string, publish_date date, media_id string, language string, query string"
)

ARTICLE_INDEX = (
    "story_id string, status string, retrieved_at timestamp, title string, text_length bigint, "
    "query string, url string, publish_date date"
)

TASK = (
    "data struct<text: string, story_id: string, title: string, url: string, language: string, "
    "publish_date: string>, external_id string"
)

ANNOTATED_TASK = (
    "id bigint, "
    "data struct<text: string, story_id: string, title: string, url: string, language: string, "
    "publish_date: string>, "
    "annotations array<struct<id: string, completed_by: string, created_by: string, "
    "created_at: string, was_cancelled: boolean, cancelled: boolean, skipped: boolean, "
    "lead_time: double, "
    "result: array<struct<type: string, from_name: string, value: variant>>>>"
)

SOURCE_CATALOGUE = (
    "source_name string, homepage_url string, present string, has_health string, "
    "has_climate string, notes string"
)

LEXICON = "term string, valence double, polarity double, subjectivity double"

PAGE = "page_id bigint, url string, html string"
