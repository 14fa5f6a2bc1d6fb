"""Batches, prompts, reply parsing, failures."""

from __future__ import annotations

import uuid
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from talkmart.operators import memory, quality, scoring
from talkmart.plans import score
from talkmart.schemas import CATEGORIES
from talkmart.sources import versions


def sentences(spark, n):
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("sentence_uuid"),
        F.concat(F.lit("연비 문장 "), F.col("id").cast("string")).alias("sentence"),
    )


def test_batches_are_full_and_complete(spark):
    rows = scoring.assign_batches(sentences(spark, 500), "sentence_uuid", files=3).collect()
    assert len(rows) == 500
    for file_no in {r.file_no for r in rows}:
        here = sorted((r for r in rows if r.file_no == file_no), key=lambda r: r.sentence_uuid)
        assert [(r.batch_no, r.pos) for r in here] == [(i // 20, i % 20) for i in range(len(here))]


def test_prompt_lines(spark):
    batched = scoring.assign_batches(sentences(spark, 3), "sentence_uuid", files=1)
    row = scoring.prompt_batches(batched).first()
    texts = [i.text for i in row["items"]]
    assert row["lines"] == "\n".join(f"{n}. {t}" for n, t in enumerate(texts, 1))


def answered(spark, n, reply):
    items = [{"pos": i, "key": f"s{i}", "text": f"t{i}"} for i in range(n)]
    return spark.createDataFrame(
        [(0, 0, items, reply)],
        "file_no int, batch_no int, items array<struct<pos: int, key: string, text: string>>, reply string",
    )


GOOD = "1. 감성: [0.8], 주제: [디자인], 부주제: [색상]"


def test_reply_line(spark):
    row = scoring.parse_replies(answered(spark, 1, f"\n{GOOD}  \n")).first()
    assert (row.sentiment_score, row.category, row.keyword, row.ok) == (0.8, "디자인", "색상", True)


def test_strict_and_tolerant(spark):
    cases = {
        "too few lines": (2, GOOD, [True, False], [True, False]),
        "extra line": (1, f"{GOOD}\n{GOOD}", [False], [True]),
        "blank line": (3, f"{GOOD}\n\n{GOOD}", [False] * 3, [True, False, True]),
        "score is no number": (2, f"{GOOD}\n2. 감성: [높음], 주제: [a], 부주제: [b]", [False] * 2, [True, False]),
        "label missing": (2, f"{GOOD}\n2. 감성: 0.1, 주제: a", [False] * 2, [True, False]),
        "no reply": (2, None, [False] * 2, [False] * 2),
    }
    for name, (n, reply, strict, tolerant) in cases.items():
        for mode, expected in ((True, strict), (False, tolerant)):
            parsed = scoring.parse_replies(answered(spark, n, reply), strict=mode)
            assert [r.ok for r in parsed.orderBy("pos").collect()] == expected, (name, mode)
            assert scoring.classified(parsed).count() + scoring.classified_failed(parsed).count() == n


def test_default_scorer_end_to_end(spark):
    df = spark.createDataFrame(
        [("a", "연비 가 좋아요"), ("b", "고장 결함"), ("c", "그냥 그래요"), ("d", "디자인, 예쁘고 색상")],
        "sentence_uuid string, sentence string",
    )
    parsed = scoring.score_sentences(df, files=2)
    rows = {r.sentence_uuid: (r.sentiment_score, r.category, r.keyword) for r in scoring.classified(parsed).collect()}
    assert rows == {"a": (0.6, "기능", "연비"), "b": (0.0, "신뢰성", "고장"), "c": (0.5, "기타", "기타"), "d": (1.0, "디자인", "디자인")}
    assert quality.score_violations(scoring.classified(parsed), CATEGORIES).count() == 0


def test_a_scorer_error_fails_its_batch_only(spark):
    def scorer(prompt):
        if "문장 7\n" in prompt:
            raise RuntimeError("no answer")
        return scoring.CueScorer()(prompt)

    parsed = scoring.score_sentences(sentences(spark, 100), scorer, files=1, carry=()).cache()
    failed = scoring.classified_failed(parsed)
    assert 0 < failed.count() <= 20
    assert scoring.classified(parsed).count() + failed.count() == 100


def test_reasons_of_failures(spark):
    def scorer(prompt):
        if "문장 7\n" in prompt:
            raise RuntimeError("no answer today")
        return scoring.CueScorer()(prompt)

    parsed = scoring.score_sentences(sentences(spark, 100), scorer, files=1, calls_at_once=4)
    rows = parsed.collect()
    assert {r.error for r in rows if not r.ok} == {"RuntimeError: no answer today"} and {r.error for r in rows if r.ok} == {None}
    reply = f"{GOOD}\nnonsense\n{GOOD}"
    for strict, want in ((False, [None, "unreadable line", None, "no line in the reply"]), (True, ["another line of the batch failed", "unreadable line", "another line of the batch failed", "no line in the reply"])):
        parsed = scoring.parse_replies(answered(spark, 4, reply).withColumn("error", F.lit(None).cast("string")), strict)
        assert [r.error for r in parsed.orderBy("pos").collect()] == want


class Counted:
    """A scorer that notes every line it is asked about in a folder; lines with a word in ``bad`` fail."""

    def __init__(self, folder, bad=()):
        self.folder, self.bad = str(folder), bad

    def __call__(self, prompt):
        lines = prompt[len(scoring.PROMPT_HEAD) : -len(scoring.PROMPT_RULES)].strip("\n").split("\n")
        Path(self.folder, uuid.uuid4().hex).write_text("\n".join(line.split(". ", 1)[1] for line in lines), encoding="utf8")
        if any(word in prompt for word in self.bad):
            raise TimeoutError("too late")
        return scoring.CueScorer()(prompt)

    def asked(self):
        files = list(Path(self.folder).iterdir())
        out = Counter(line for f in files for line in f.read_text(encoding="utf8").split("\n"))
        for f in files:
            f.unlink()
        return out


def test_each_text_is_asked_about_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    scorer, store = Counted(tmp_path / "calls"), str(tmp_path / "memory")
    texts = ["연비가 좋아요", "고장이 잦아요", "", None, *["같은 문장"] * 300]
    rows = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "sentence_uuid string, sentence string")
    first = score.score_with_memory(rows, store, scorer).collect()
    assert len(first) == len(texts) and all(r.ok for r in first)
    assert scorer.asked() == Counter({"연비가 좋아요": 1, "고장이 잦아요": 1, "같은 문장": 1, "": 1})
    again = score.score_with_memory(rows, store, scorer).collect()
    assert sorted(map(str, again)) == sorted(map(str, first)) and not scorer.asked()
    more = rows.unionByName(spark.createDataFrame([("n", "디자인이 예쁘네요")], rows.schema))
    assert score.score_with_memory(more, store, scorer).count() == len(texts) + 1
    assert scorer.asked() == Counter({"디자인이 예쁘네요": 1})
    # Another scorer or prompt has no answers yet.
    score.score_with_memory(rows, store, scorer, scorer_id="other").count()
    assert sum(scorer.asked().values()) == 4


def test_failed_texts_are_asked_again_and_say_why(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    store = str(tmp_path / "memory")
    rows = spark.createDataFrame([("a", "고장이 잦아요"), ("b", "고장이 잦아요")], "sentence_uuid string, sentence string")
    for attempt in (1, 2):
        failed = score.score_with_memory(rows, store, Counted(tmp_path / "calls", ["고장"])).collect()
        assert [(r.ok, r.error) for r in failed] == [(False, "TimeoutError: too late")] * 2
        stored = versions.read_keyed(spark, store, memory.MEMORY, ["text_key"]).collect()
        assert [(r.ok, r.attempts) for r in stored] == [(False, attempt)]
    good = Counted(tmp_path / "calls")
    good.asked()
    assert all(r.ok and r.error is None for r in score.score_with_memory(rows, store, good).collect())
    assert good.asked() == Counter({"고장이 잦아요": 1})
    stored = versions.read_keyed(spark, store, memory.MEMORY, ["text_key"]).collect()
    assert [(r.ok, r.attempts, r.error) for r in stored] == [(True, 3, None)]
    assert score.score_with_memory(rows.limit(0), store, good).collect() == []


def test_carried_columns(spark):
    df = sentences(spark, 5).withColumn("dt", F.lit("2025-01-01").cast("date"))
    parsed = scoring.score_sentences(df, files=1, carry=["dt"])
    assert {str(r.dt) for r in scoring.classified(parsed, ["dt"]).collect()} == {"2025-01-01"}


def test_join_by_position(spark):
    rows = scoring.assign_batches(sentences(spark, 30), "sentence_uuid", files=2)
    scores = rows.select("file_no", "batch_no", "pos", F.col("sentence_uuid").alias("again"))
    joined = scoring.attach_by_position(rows, scores)
    assert joined.count() == 30 and joined.filter("again <> sentence_uuid").count() == 0


def test_a_batch_is_judged_before_its_sentences_are_taken_apart(spark):
    rows = answered(spark, 3, "1. 감성: [0.5], 주제: [a], 부주제: [b]")
    plan = scoring.parse_replies(rows)._jdf.queryExecution().optimizedPlan().toString()
    # The plan is read upwards: what finds bad lines stands below the explode, so it runs once a batch.
    assert plan.count("exists(") >= 1 and plan.index("posexplode(") < plan.index("exists(")


def test_memory_path_neither_sorts_texts_nor_takes_them_along(spark):
    rows = [(f"u{i}", f"good design {i % 7}") for i in range(50)] + [("n", None), ("e", "")]
    texts = memory.distinct_texts(spark.createDataFrame(rows, "sentence_uuid string, sentence string"), "v")
    assert sorted(r.text for r in texts.collect()) == sorted({text or "" for _, text in rows})
    assert "SortAggregate" not in texts._jdf.queryExecution().executedPlan().toString()
    full, bare = (scoring.score_sentences(texts, key="text_key", text="text", keep_text=k) for k in (True, False))
    assert "sentence" in full.columns and "sentence" not in bare.columns
    assert sorted(full.drop("sentence").collect()) == sorted(bare.collect())


def test_a_line_is_read_once_for_its_batch_and_its_sentence(spark):
    rows = [(0, 0, [("a", "x"), ("b", "y"), ("c", "z")], "1. 감성: [0.5], 주제: [k], 부주제: [w]\nbad")]
    answered = spark.createDataFrame(rows, "file_no int, batch_no int, items array<struct<key:string,text:string>>, reply string")
    strict, tolerant = (scoring.parse_replies(answered, strict=s) for s in (True, False))
    assert [r.ok for r in strict.orderBy("pos").collect()] == [False] * 3
    assert [(r.sentence_uuid, r.sentence, r.sentiment_score, r.ok) for r in tolerant.orderBy("pos").collect()] == [
        ("a", "x", 0.5, True),
        ("b", "y", None, False),
        ("c", "z", None, False),
    ]
