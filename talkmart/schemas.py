"""Every table of the data model, declared once.

Readers, validators, constraint checks and table definitions are derived from
the declarations here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """``"a string, b int"`` -> StructType; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, order and types of the exchanged tables.
RAW_COMMENT = _schema(
    "comment_content string, comment_nickname string, comment_date int,"
    " comment_like_count int, comment_dislike_count int"
)
RAW = _schema(
    "car_name string, source string, id string, title string, nickname string, article string,"
    " view_count int, like_count int, dislike_count int, date int, comment_count int"
).add("comments", T.ArrayType(RAW_COMMENT))
POST_DATA = _schema(
    "post_uuid string, post_id string, title string, author string, article string,"
    " create_timestamp int, like_cnt int, dislike_cnt int, view_cnt int, comment_cnt int,"
    " car_name string, source string"
)
COMMENT_DATA = _schema(
    "post_uuid string, comment_uuid string, comment_id string, author string, content string,"
    " create_timestamp int, like_cnt int, dislike_cnt int"
)
SENTENCE_DATA = _schema(
    "post_uuid string, comment_uuid string, sentence_uuid string, type string, sentence string"
)
CLASSIFIED = _schema("sentence_uuid string, sentiment_score double, category string, keyword string")
CLASSIFIED_FAILED = _schema("sentence_uuid string, sentence string")
FLAT_TEXT = _schema("text string, date int, like_count int, view_count int, source string")

# Partition columns of every stage table that the jobs write.
STAGE_PARTITIONS = _schema("dt date, car_name string")


def staged(schema: T.StructType) -> T.StructType:
    """A stage table's schema with its partition columns."""
    extra = [f for f in STAGE_PARTITIONS.fields if f.name not in schema.fieldNames()]
    return T.StructType([*schema.fields, *extra])


COUNTERS = ("like_count", "dislike_count", "view_count", "comment_count")
SOURCES = ("bobae", "clien", "youtube")
CATEGORIES = ("디자인", "기능", "신뢰성", "기타")

# The nine cars and their comma-separated search words.
CAR_ALIASES = {
    "Grandeur": "그랜져,그랜저",
    "Santafe": "싼타페,산타페",
    "Casper": "캐스퍼",
    "Palisade": "팰리세이드",
    "Sonata": "쏘나타,소나타",
    "Avante": "아반떼,아반테",
    "Kona": "코나",
    "Tucson": "투싼",
    "Venue": "베뉴",
}


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str


@dataclass(frozen=True)
class Table:
    """A warehouse table: columns plus the constraints that go with them."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def ddl(self, location: str | None = None) -> str:
        """``CREATE TABLE`` text for a catalog that keeps the mart as Parquet."""
        lines = [
            f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name in self.not_null else ''}"
            for f in self.schema.fields
        ]
        text = f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(lines)}) USING parquet"
        if "ingestion_date" in self.columns:
            text += " PARTITIONED BY (ingestion_date, car_name)"
        return text if location is None else f"{text} LOCATION '{location}'"


def _table(name, ddl, key=(), nullable=(), long_text=(), fks=()) -> Table:
    schema = _schema(ddl)
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = {c: 65535 if c in long_text else 36 if c.endswith("_uuid") else 255 for c in strings}
    required = tuple(c for c in schema.fieldNames() if c not in nullable)
    return Table(name, schema, tuple(key), required, lengths, tuple(ForeignKey(*fk) for fk in fks))


_DIMS = ((("car_name",), "tb_car"), (("source",), "tb_web_source"))

STAGING = {
    t.name: t
    for t in (
        _table(
            "posts",
            "post_uuid string, post_id string, title string, author string, article string,"
            " create_timestamp bigint, like_cnt bigint, dislike_cnt bigint, view_cnt bigint,"
            " comment_cnt bigint, car_name string, source string",
            nullable=("like_cnt", "dislike_cnt", "view_cnt", "comment_cnt"),
            long_text=("article",),
        ),
        _table(
            "comments",
            "post_uuid string, comment_uuid string, comment_id string, author string,"
            " content string, create_timestamp bigint, like_cnt bigint, dislike_cnt bigint",
            nullable=("like_cnt", "dislike_cnt"),
            long_text=("content",),
        ),
        _table(
            "sentences",
            "post_uuid string, comment_uuid string, sentence_uuid string, type string, sentence string",
            nullable=("comment_uuid",),
            long_text=("sentence",),
        ),
        _table(
            "keywords",
            "sentence_uuid string, sentiment_score double, category string, keyword string",
        ),
    )
}

# Staging table -> directory the text and scoring jobs write it to, and its schema there.
STAGING_DIRS = {
    "posts": ("post_data", POST_DATA),
    "comments": ("comment_data", COMMENT_DATA),
    "sentences": ("sentence_data", SENTENCE_DATA),
    "keywords": ("classified", CLASSIFIED),
}

MART = {
    t.name: t
    for t in (
        _table(
            "tb_posts",
            "post_id string, title string, author string, article string, create_date date",
            key=("post_id",),
            long_text=("article",),
        ),
        _table(
            "tb_comments",
            "post_id string, comment_id string, author string, content string, create_date date",
            key=("post_id", "comment_id"),
            long_text=("content",),
        ),
        _table(
            "tb_car",
            "car_name string, pre_car_name string, release_date date",
            key=("car_name",),
            nullable=("pre_car_name",),
        ),
        _table("tb_web_source", "source string, age string", key=("source",)),
        _table(
            "tb_posts_metric",
            "post_id string, car_name string, source string, like_cnt bigint, dislike_cnt bigint,"
            " view_cnt bigint, comment_cnt bigint, ingestion_date date",
            nullable=("like_cnt", "dislike_cnt", "view_cnt", "comment_cnt"),
            fks=((("post_id",), "tb_posts"), *_DIMS),
        ),
        _table(
            "tb_comments_metric",
            "post_id string, comment_id string, car_name string, source string, like_cnt bigint,"
            " dislike_cnt bigint, ingestion_date date",
            nullable=("comment_id", "like_cnt", "dislike_cnt"),
            fks=((("post_id", "comment_id"), "tb_comments"), *_DIMS),
        ),
        _table(
            "tb_keywords",
            "post_id string, comment_id string, car_name string, source string, type string,"
            " sentence string, category string, keyword string, sentiment_score double,"
            " ingestion_date date",
            nullable=("comment_id",),
            long_text=("sentence",),
            fks=((("post_id", "comment_id"), "tb_comments"), *_DIMS),
        ),
    )
}

_LISTENING_ROW = (
    "post_id string, comment_id string, type string, sentence string, category string, keyword string,"
    " sentiment_score double, ingestion_date date, car_name string, pre_car_name string, release_date date,"
    " source string, age string"
)
_ATTENTION_ROW = (
    "post_id string, comment_id string, like_cnt bigint, dislike_cnt bigint, view_cnt bigint, comment_cnt bigint,"
    " ingestion_date date, car_name string, pre_car_name string, release_date date, source string, age string"
)
VIEWS = {
    name: Table(name, _schema(columns))
    for name, columns in (("vw_social_listening", _LISTENING_ROW), ("vw_social_attention", _ATTENTION_ROW))
}
