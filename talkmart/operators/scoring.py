"""Sentence scoring: batches of 20, one prompt and one reply per batch.

The scorer is any function from prompt text to reply text. Everything around it
(batching, prompt text, reply parsing, failures) is Column expressions, and a
batch is at most 20 rows, so no group is ever large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once

BATCH_SIZE = 20

# Instruction text of our own, then fixed values: the reply format the scorer is asked for.
PROMPT_HEAD = "다음은 자동차에 대한 문장 목록입니다. 문장마다 감성 점수와 주제, 부주제를 매겨 주세요:"
PROMPT_RULES = (
    "감성 점수는 0(부정)부터 1(긍정)까지, 0.5는 중립.\n"
    "주제는 디자인, 기능, 신뢰성, 기타 중 하나.\n"
    "부주제는 주제와 연관된 단어 하나.\n"
    "출력 형식:\n"
    "1. 감성: [감성 점수], 주제: [주제], 부주제: [부주제]"
)
SCORE_LABEL, CATEGORY_LABEL, KEYWORD_LABEL = "감성:", "주제:", "부주제:"
PART_SEPARATOR = ", "


def assign_batches(df: DataFrame, key: str, files: int = 10, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Adds ``file_no``, ``batch_no`` and ``pos``: rows 0..19 of a file form batch 0, and so on.

    A file is an md5 bucket of the row's unique key, so all files have about the
    same size; ``files`` grows with the data (see ``plans.score.file_count``).
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key)), 1, 7), 16, 10).cast("int"), F.lit(files))
    rank = F.row_number().over(Window.partitionBy("file_no").orderBy(key)) - 1
    return (
        df.withColumn("file_no", bucket)
        .withColumn("_rank", rank)
        .withColumn("batch_no", F.floor(F.col("_rank") / batch_size).cast("int"))
        .withColumn("pos", F.pmod("_rank", F.lit(batch_size)).cast("int"))
        .drop("_rank")
    )


def numbered_lines(items: Column, text_field: str) -> Column:
    """``1. first`` newline ``2. second`` … from an array of structs."""
    lines = F.transform(
        items, lambda item, i: F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(item[text_field], F.lit("")))
    )
    return F.array_join(lines, "\n")


def prompt_batches(
    batched: DataFrame, key: str = "sentence_uuid", text: str = "sentence", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per batch: its items in order and the numbered lines for the prompt."""
    item = F.struct("pos", F.col(key).alias("key"), F.col(text).alias("text"), *carry)
    grouped = batched.groupBy("file_no", "batch_no").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.withColumn("lines", numbered_lines(F.col("items"), "text"))


def full_prompt(lines: Column) -> Column:
    return F.concat_ws("\n\n", F.lit(PROMPT_HEAD), lines, F.lit(PROMPT_RULES))


@dataclass(frozen=True)
class Cue:
    """A word, what it adds to the neutral score, and the category it points to."""

    word: str
    weight: float
    category: str


# Fixed values of the offline scorer.
DEFAULT_CUES = (
    Cue("디자인", 0.1, "디자인"),
    Cue("예쁘", 0.3, "디자인"),
    Cue("색상", 0.1, "디자인"),
    Cue("연비", 0.1, "기능"),
    Cue("편하", 0.2, "기능"),
    Cue("불편", -0.3, "기능"),
    Cue("고장", -0.4, "신뢰성"),
    Cue("결함", -0.4, "신뢰성"),
    Cue("안전", 0.2, "신뢰성"),
)


class CueScorer:
    """Default scorer: answers a prompt from a word list, without any network."""

    def __init__(self, cues: Sequence[Cue] = DEFAULT_CUES, other: str = "기타"):
        self.cues = tuple(cues)
        self.other = other

    def __call__(self, prompt: str) -> str:
        """``prompt`` holds the numbered lines only, or the whole instruction text."""
        lines = prompt
        if prompt.startswith(PROMPT_HEAD):
            lines = prompt[len(PROMPT_HEAD) : -len(PROMPT_RULES)].strip("\n")
        return "\n".join(self._answer(n, line) for n, line in enumerate(lines.split("\n"), 1))

    def _answer(self, n: int, line: str) -> str:
        hits = [cue for cue in self.cues if cue.word in line]
        score = min(1.0, max(0.0, round(0.5 + sum(cue.weight for cue in hits), 2)))
        category, keyword = (hits[0].category, hits[0].word) if hits else (self.other, self.other)
        return f"{n}. {SCORE_LABEL} [{score}], {CATEGORY_LABEL} [{category}], {KEYWORD_LABEL} [{keyword}]"


#: Replies given on together.
_HANDED_ON = 16
_ANSWERED = "file_no int, batch_no int, items_json string, prompt string, reply string, error string"
#: Characters of a scorer's error that are kept.
ERROR_CHARS = 500


def ask(
    batches: DataFrame,
    scorer: Callable[[str], str] | None = None,
    tasks: int | None = None,
    calls_at_once: int = 1,
) -> DataFrame:
    """Adds ``reply`` and ``error``. A scorer error gives a NULL reply and its text, and fails that batch only.

    Batches are dealt out over ``tasks`` tasks (the shuffle width by default), whatever
    file they are in, so calls run side by side; replies are handed on a few at a time.
    Within a task up to ``calls_at_once`` calls run at a time, for a scorer that mostly waits.
    The items travel as JSON next to the prompt, so replies need no join back.
    """
    ask_one = scorer or CueScorer()
    tasks = tasks or int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def answer(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(calls_at_once) as calls:
            for chunk in chunks:
                for start in range(0, len(chunk), max(_HANDED_ON, calls_at_once)):
                    some = chunk.iloc[start : start + max(_HANDED_ON, calls_at_once)]
                    replies = list(calls.map(partial(_safely, ask_one), some["prompt"]))
                    columns = zip(*replies, strict=True)
                    yield some.assign(**{n: pd.Series(c, index=some.index, dtype=object) for n, c in zip(("reply", "error"), columns, strict=True)})

    asked = batches.select(
        "file_no",
        "batch_no",
        F.to_json("items").alias("items_json"),
        full_prompt(F.col("lines")).alias("prompt"),
    )
    answered = asked.repartition(tasks, "file_no", "batch_no").mapInPandas(answer, _ANSWERED)
    items = F.from_json("items_json", batches.schema["items"].dataType)
    return computed_once(answered, ["file_no", "batch_no", "reply", "error"], {"items": items})


def _safely(scorer: Callable[[str], str], prompt: str) -> tuple[str | None, str | None]:
    """Reply and error of one call; any error of the scorer is a failed batch."""
    try:
        return scorer(prompt), None
    except Exception as error:  # noqa: BLE001
        return None, f"{type(error).__name__}: {error}"[:ERROR_CHARS]


def _labelled(line: Column, index: int, label: str) -> Column:
    part = F.try_element_at(F.split(line, PART_SEPARATOR), F.lit(index))
    value = F.try_element_at(F.split(part, label), F.lit(2))
    return F.regexp_replace(F.trim(value), r"[\[\]]", "")


def parse_line(line: Column) -> list[Column]:
    """Score, category and keyword of one reply line; NULL where a part is missing."""
    return [
        F.trim(_labelled(line, 1, SCORE_LABEL)).try_cast("double").alias("sentiment_score"),
        _labelled(line, 2, CATEGORY_LABEL).alias("category"),
        _labelled(line, 3, KEYWORD_LABEL).alias("keyword"),
    ]


def reply_lines(reply: Column) -> Column:
    return F.split(F.regexp_replace(reply, r"^\s+|\s+$", ""), "\n")


def parse_replies(answered: DataFrame, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """``items`` + ``reply`` -> one row per sentence, with ``ok``.

    Lines belong to sentences by position, inside the row, so nothing is joined.
    Strict: a bad line, or more lines than sentences, fails the whole batch.
    Tolerant: only the sentence of a bad line fails. A sentence without a line
    fails in both cases, it is never lost. Where ``answered`` has ``error``, the
    rows say why a sentence failed: the scorer's error, or what the reply lacks.
    """
    with_error = "error" in answered.columns
    kept = ["file_no", "batch_no", "items", *(["error"] if with_error else [])]
    batches = computed_once(answered, kept, {"_all": reply_lines(F.col("reply"))})
    # A line is read once, for the whole batch and for its sentence, and a sentence takes along only what its own line gave.
    lines = F.transform("_all", lambda line: F.struct(*parse_line(line)))
    batches = computed_once(batches, kept, {"_read": lines})
    broken = _batch_broken(F.col("_read"), F.size("items")) if strict else F.lit(False)
    pairs = F.transform("items", lambda item, i: F.struct(item.alias("item"), F.try_element_at(F.col("_read"), i + 1).alias("read")))
    batches = computed_once(batches, [c for c in kept if c != "items"], {"_broken": broken, "_pairs": pairs})
    read = batches.select(
        "file_no",
        "batch_no",
        "_broken",
        *([F.col("error").alias("_error")] if with_error else []),
        F.posexplode("_pairs").alias("pos", "_pair"),
    ).select(
        "file_no",
        "batch_no",
        "pos",
        F.col("_pair.item").alias("item"),
        "_broken",
        *(["_error"] if with_error else []),
        "_pair.read.*",
        F.col("_pair.read").isNotNull().alias("_answered"),
    )
    complete = (
        F.col("sentiment_score").isNotNull() & F.col("category").isNotNull() & F.col("keyword").isNotNull()
    )
    reason = (
        F.when(complete & ~F.col("_broken"), None)
        .when(~F.col("_answered"), "no line in the reply")
        .when(~complete, "unreadable line")
        .otherwise("another line of the batch failed")
    )
    why = [F.coalesce(F.col("_error"), reason).alias("error")] if with_error else []
    return read.select(
        "file_no",
        "batch_no",
        "pos",
        F.col("item.key").alias("sentence_uuid"),
        *([F.col("item.text").alias("sentence")] if "text" in answered.schema["items"].dataType.elementType.names else []),
        *(F.col(f"item.{c}").alias(c) for c in carry),
        "sentiment_score",
        "category",
        "keyword",
        (complete & ~F.col("_broken")).alias("ok"),
        *why,
    )


def _batch_broken(lines: Column, asked: Column) -> Column:
    """``lines`` are read ones: score, category and keyword of each."""

    def bad(line: Column) -> Column:
        return line["sentiment_score"].isNull() | line["category"].isNull() | line["keyword"].isNull()

    return F.coalesce((F.size(lines) > asked) | F.exists(lines, bad), F.lit(True))


def classified(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return parsed.filter("ok").select("sentence_uuid", "sentiment_score", "category", "keyword", *carry)


def classified_failed(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return parsed.filter(~F.col("ok")).select("sentence_uuid", "sentence", *carry)


def attach_by_position(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Join separately stored scores back to rows by file, batch and position."""
    return rows.join(scores, ["file_no", "batch_no", "pos"], "left")


def score_sentences(
    sentences: DataFrame,
    scorer: Callable[[str], str] | None = None,
    files: int = 10,
    strict: bool = True,
    key: str = "sentence_uuid",
    text: str = "sentence",
    carry: Sequence[str] = (),
    calls_at_once: int = 1,
    keep_text: bool = True,
) -> DataFrame:
    """Sentences -> parsed replies with ``ok`` and ``error``; see ``classified`` and ``classified_failed``.

    Without ``keep_text`` a text goes to the scorer in its prompt only and does not come back.
    """
    batched = assign_batches(sentences.select(key, text, *carry), key, files)
    batches = prompt_batches(batched, key, text, carry)
    if not keep_text:
        batches = batches.withColumn("items", F.transform("items", lambda item: item.dropFields("text")))
    return parse_replies(ask(batches, scorer, calls_at_once=calls_at_once), strict, carry)
