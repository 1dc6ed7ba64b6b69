"""One frozen settings object; its defaults are the values that decide results, and all of them are really used."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    # attachment filter
    min_bytes: int = 15_000
    max_pdf_bytes: int = 80_000_000
    max_bytes: int = 100_000_000
    # attachment ranking
    peeks: int = 5
    full_extracts: int = 5
    supporting: int = 4
    idea_words: int = 80
    supporting_words: int = 40
    # descriptions
    junk_below: int = 10
    thin_below: int = 50
    usable_below: int = 150
    # chunks
    max_slides: int = 60
    page_words: int = 400
    page_min_words: int = 40
    section_min_words: int = 10
    fallback_at: int = 8
    fallback_group: int = 4
    supplementary_chars: int = 3000
    supplementary_words: int = 30
    # comments
    comment_words: int = 50
    comment_chars: int = 2000
    # vectors
    embedding_batch: int = 512
    embedding_model: str = "text-embedding-3-large"
    field_map: dict[str, str] = field(default_factory=dict)


DEFAULT = Settings()

#: Vector lengths by model name, and of any other model.
EMBEDDING_DIMS = {"text-embedding-3-large": 3072, "text-embedding-3-small": 1536, "text-embedding-ada-002": 1536, "embed-english-v3.0": 1024}
EMBEDDING_DIM_DEFAULT = 1536

#: The fields asked of the tracker besides configured custom fields.
BASE_FIELDS = (
    "summary", "description", "reporter", "created", "updated", "labels", "components", "priority",
    "status", "issuetype", "resolution", "issuelinks", "comment", "attachment", "parent",
)


def requested_fields(field_map: dict[str, str]) -> list[str]:
    """The base fields, then the configured custom fields, sorted and once each."""
    return [*BASE_FIELDS, *sorted({v for v in field_map.values() if v and v.startswith("customfield_")})]
