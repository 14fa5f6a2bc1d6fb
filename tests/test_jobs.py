"""Jobs end to end on small folders: text, scoring, load, collection, prototype, stream."""

from __future__ import annotations

import json
from collections import Counter
from datetime import date
from functools import partial

from talkmart import schemas, session
from talkmart.operators import memory, pages, quality, views
from talkmart.plans import collect, load, prototype, score, text_job, validate
from talkmart.sources import readers, versions, writers
from talkmart.streaming import landing
from tests.test_pages import COMMENT, PROFILE, frame
from tests.test_records import record

DAY, NEXT = "2025-02-01", "2025-02-02"
NOON = 1738335600 + 43200


def _post(id_, car="Kona", when=NOON, comments=(), **more):
    text = "연비가 정말 좋아요 추천합니다\nshort\n고장이 자주 나서 불편합니다!!!"
    rec = record(id_, comments, **{"car_name": car, "title": "디자인이 예쁘네요 새로운 모델", "article": text, "date": when, **more})
    for c in rec["comments"]:
        c["comment_date"] = when
    return rec


def _write_raw(root, day, name, records):
    folder = root / "raw" / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(records, ensure_ascii=False), encoding="utf8")


def _run(spark, root, first=DAY, last=None, **kw):
    raw = text_job.read_raw_days(spark, str(root / "raw"), text_job.days_between(first, last))
    text_job.run_text_job(spark, raw, str(root / "stage"), first, last, **kw)


def _table(spark, root, name):
    return spark.read.parquet(str(root / "stage" / name))


def _contents(spark, root):
    names = ("failed_raw", "post_data", "comment_data", "sentence_data")
    return {n: Counter(map(str, _table(spark, root, n).select(*sorted(_table(spark, root, n).columns)).collect())) for n in names}


def test_text_job(spark, tmp_path):
    kona = _post("clien_1", comments=[("u", "저도 연비가 만족스럽습니다 정말"), ("v", "짧다")])
    _write_raw(tmp_path, DAY, "clien.json", [kona, _post("clien_2", "Venue", when=NOON - 86400 * 3), _post("bad", like_count=-1)])
    _write_raw(tmp_path, DAY, "youtube_1.json", [kona, {**_post("y"), "view_count": 3_000_000_000}])
    _run(spark, tmp_path)
    failed, posts = _table(spark, tmp_path, "failed_raw"), _table(spark, tmp_path, "post_data")
    assert sorted(r.id for r in failed.collect()) == ["bad", "y"]
    assert sorted(r.post_id for r in posts.collect()) == ["clien_1", "clien_1", "clien_2"]
    assert posts.select("post_uuid").distinct().count() == 3
    comments, sentences = _table(spark, tmp_path, "comment_data"), _table(spark, tmp_path, "sentence_data")
    # Both copies of the post keep their own two comments.
    assert comments.join(posts.select("post_uuid"), "post_uuid").count() == 4
    # The old post is stored, but only the day's own posts give sentences.
    assert sentences.join(posts, "post_uuid").select("post_id").distinct().collect()[0].post_id == "clien_1"
    per_copy = ["디자인이 예쁘네요 새로운 모델", "연비가 정말 좋아요 추천합니다", "고장이 자주 나서 불편합니다!", "저도 연비가 만족스럽습니다 정말"]
    assert Counter(r.sentence for r in sentences.collect()) == Counter(per_copy * 2)
    assert sentences.join(posts, "post_uuid", "left_anti").count() == 0

    once = _contents(spark, tmp_path)
    _run(spark, tmp_path)
    assert _contents(spark, tmp_path) == once
    # A rerun in which a car has no rows any more leaves none behind.
    _write_raw(tmp_path, DAY, "clien.json", [kona])
    _run(spark, tmp_path)
    assert {r.car_name for r in _table(spark, tmp_path, "post_data").collect()} == {"Kona"}


def test_text_job_of_one_car_and_fixed_files(spark, tmp_path):
    _write_raw(tmp_path, DAY, "a.json", [_post("k"), _post("v", "Venue")])
    _run(spark, tmp_path)
    _run(spark, tmp_path, cars=["Venue"], files=3)
    assert {r.car_name for r in _table(spark, tmp_path, "sentence_data").collect()} == {"Kona", "Venue"}
    assert _table(spark, tmp_path, "sentence_data").count() == 6


def _days(spark, root):
    _write_raw(root, DAY, "clien.json", [_post("clien_1", comments=[("u", "저도 연비가 만족스럽습니다 정말")]), _post("clien_2", "Venue")])
    _write_raw(root, NEXT, "clien.json", [_post("clien_1", comments=[("u", "저도 연비가 만족스럽습니다 정말")], view_count=77), _post("clien_3", when=NOON + 86400)])
    cars = spark.createDataFrame(
        [("Kona", None, date(2025, 2, 2)), ("Venue", "Old", date(2025, 2, 2))], schemas.MART["tb_car"].schema
    )
    return cars, spark.createDataFrame([("clien", "30s")], schemas.MART["tb_web_source"].schema)


def _mart(spark, mart):
    facts = {n: load.read_fact(spark, mart, n) for n in ("tb_posts_metric", "tb_comments_metric", "tb_keywords")}
    dims = {n: load.read_dimension(spark, mart, n) for n in ("tb_posts", "tb_comments")}
    return facts | dims


def test_days_to_mart(spark, tmp_path):
    cars, sources = _days(spark, tmp_path)
    stage, mart = str(tmp_path / "stage"), str(tmp_path / "mart")
    for day in (DAY, NEXT):
        _run(spark, tmp_path, day)
        score.run_scoring(spark, stage, day)
        load.load_days(spark, stage, mart, cars, sources, day)
    tables = _mart(spark, mart)
    once = {n: Counter(map(str, df.collect())) for n, df in tables.items()}
    assert sorted((r.post_id, str(r.ingestion_date), r.view_cnt) for r in tables["tb_posts_metric"].collect()) == [
        ("clien_1", DAY, 3), ("clien_1", NEXT, 77), ("clien_2", DAY, 3), ("clien_3", NEXT, 3),
    ]
    assert sorted(r.post_id for r in tables["tb_posts"].collect()) == ["clien_1", "clien_2", "clien_3"]
    assert tables["tb_comments"].count() == 1 and tables["tb_comments_metric"].count() == 2
    # Sentences come on the day of the post only, so the second day adds clien_3's.
    assert Counter(r.post_id for r in tables["tb_keywords"].collect()) == {"clien_1": 4, "clien_2": 3, "clien_3": 3}

    load.load_days(spark, stage, mart, cars, sources, NEXT)
    assert {n: Counter(map(str, df.collect())) for n, df in _mart(spark, mart).items()} == once

    listening = load.read_view(spark, mart, "vw_social_listening")
    assert listening.count() == 10 and {r.age for r in listening.collect()} == {"30s"}
    attention = load.read_view(spark, mart, "vw_social_attention")
    assert Counter(r.post_id for r in attention.collect()) == {"clien_1": 2, "clien_2": 1, "clien_3": 1}
    load.refresh_views(spark, mart, cars, sources, same_day=False)
    attention = load.read_view(spark, mart, "vw_social_attention")
    # clien_1: two post snapshots by two comment snapshots.
    assert Counter(r.post_id for r in attention.collect()) == {"clien_1": 4, "clien_2": 1, "clien_3": 1}
    assert load.read_view(spark, mart, "vw_social_listening").count() == 10
    # Versions are numbers; a load that changes no row of a dimension makes none.
    assert versions.version_ids(spark, f"{mart}/tb_posts") == ["0000000001", "0000000002"]

    load.create_fact_tables(spark, mart)
    assert spark.table("tb_keywords").count() == 10
    tables = _mart(spark, mart)
    report = quality.constraint_report(tables["tb_keywords"], schemas.MART["tb_keywords"], tables | {"tb_car": cars, "tb_web_source": sources})
    assert {r.rule: r.violations for r in report.collect() if r.violations} == {}


def _views(spark, mart):
    return {n: Counter(map(str, load.read_view(spark, mart, n).collect())) for n in schemas.VIEWS}


def _rebuilt(spark, mart, cars, sources):
    facts = [load.read_fact(spark, mart, n) for n in ("tb_posts_metric", "tb_comments_metric", "tb_keywords")]
    attention = views.social_attention(*facts[:2], cars, sources, same_day=True)
    rows = {"vw_social_attention": attention, "vw_social_listening": views.social_listening(facts[2], cars, sources)}
    return {n: Counter(map(str, rows[n].select(*schemas.VIEWS[n].columns).collect())) for n in schemas.VIEWS}


def test_maintained_views_equal_rebuilt_ones(spark, tmp_path):
    cars, sources = _days(spark, tmp_path)
    stage, mart = str(tmp_path / "stage"), str(tmp_path / "mart")
    _run(spark, tmp_path, DAY, NEXT)
    score.run_scoring(spark, stage, DAY, NEXT)
    for day, some in ((NEXT, ["Kona"]), (DAY, None), (NEXT, None)):
        load.load_days(spark, stage, mart, cars, sources, day, cars=some)
        assert _views(spark, mart) == _rebuilt(spark, mart, cars, sources)
    base = f"{mart}/vw_social_attention"
    before = versions.manifest(spark, base)
    # Other counters of one post on the second day, one more post, one less: the first day's part is not written.
    _write_raw(tmp_path, NEXT, "clien.json", [_post("clien_1", comments=[("u", "저도 연비가 만족스럽습니다 정말")], view_count=78), _post("clien_4", when=NOON + 86400)])
    _run(spark, tmp_path, NEXT)
    score.run_scoring(spark, stage, NEXT)
    load.load_days(spark, stage, mart, cars, sources, NEXT)
    assert _views(spark, mart) == _rebuilt(spark, mart, cars, sources)
    after = versions.manifest(spark, base)
    assert {p for p in before if p.unit == DAY} == {p for p in after if p.unit == DAY}
    assert {p for p in before if p.unit == NEXT} != {p for p in after if p.unit == NEXT}
    # The same load again: no fact differs, so the view keeps its version.
    load.load_days(spark, stage, mart, cars, sources, NEXT)
    assert versions.manifest(spark, base) == after
    # Another dimension row changes both views as a whole, and back.
    load.load_days(spark, stage, mart, cars.filter("car_name = 'Kona'"), sources, NEXT)
    assert _views(spark, mart) == _rebuilt(spark, mart, cars.filter("car_name = 'Kona'"), sources)


def test_a_mart_of_whole_snapshots_is_taken_over(spark, tmp_path):
    cars, sources = _days(spark, tmp_path)
    stage, mart = str(tmp_path / "stage"), str(tmp_path / "mart")
    _run(spark, tmp_path)
    score.run_scoring(spark, stage, DAY)
    old = [("clien_1", "kept", "a", "x", date(2025, 1, 1), date(2026, 1, 1), "Kona"), ("gone", "t", "a", "x", date(2025, 1, 1), date(2025, 1, 1), "Kona")]
    writers.write_snapshot(spark.createDataFrame(old, load.stored_dimension("tb_posts")), f"{mart}/tb_posts", "0000000007")
    load.load_days(spark, stage, mart, cars, sources, DAY)
    posts = {r.post_id: r.title for r in load.read_dimension(spark, mart, "tb_posts").collect()}
    assert posts == {"clien_1": "kept", "gone": "t", "clien_2": posts["clien_2"]}
    assert readers.snapshot_ids(spark, f"{mart}/tb_posts") == []


def test_backfill_of_two_days_equals_two_runs(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    cars, sources = _days(spark, one)
    _days(spark, two)
    for day in (DAY, NEXT):
        _run(spark, one, day)
    _run(spark, two, DAY, NEXT)

    def facts(root):
        posts = _table(spark, root, "post_data").drop("post_uuid")
        sentences = _table(spark, root, "sentence_data").select("dt", "car_name", "type", "sentence")
        return Counter(map(str, posts.select(*sorted(posts.columns)).collect())), Counter(map(str, sentences.collect()))

    assert facts(one) == facts(two)


def test_scoring_failures_and_retry(spark, tmp_path):
    _write_raw(tmp_path, DAY, "a.json", [_post("k")])
    _run(spark, tmp_path)
    stage = str(tmp_path / "stage")

    def silent(prompt):
        raise TimeoutError

    score.run_scoring(spark, stage, DAY, scorer=silent)
    assert spark.read.parquet(f"{stage}/classified_failed").count() == 3
    again = score.retry_failed(spark, stage, DAY)
    assert again.count() == 3
    landed = spark.read.parquet(f"{stage}/classified")
    assert landed.count() == landed.select("sentence_uuid").distinct().count() == 3
    assert spark.read.schema("sentence_uuid string, dt date, car_name string").parquet(f"{stage}/classified_failed").count() == 0
    assert score.retry_failed(spark, stage, DAY).count() == 0
    assert spark.read.parquet(f"{stage}/classified").count() == 3


def test_a_rerun_with_a_score_memory_asks_nothing(spark, tmp_path):
    _write_raw(tmp_path, DAY, "a.json", [_post("k"), _post("l"), _post("v", "Venue")])
    _run(spark, tmp_path)
    stage, store = str(tmp_path / "stage"), str(tmp_path / "memory")
    score.run_scoring(spark, stage, DAY, memory=store)
    rows = lambda: Counter(map(str, spark.read.parquet(f"{stage}/classified").collect()))
    first = rows()
    # The same three texts in three posts.
    assert sum(first.values()) == 9 and spark.read.parquet(f"{stage}/scored").filter("ok").count() == 9
    assert versions.read_keyed(spark, store, memory.MEMORY, ["text_key"]).count() == 3

    def nobody(prompt):
        raise AssertionError("asked")

    score.run_scoring(spark, stage, DAY, memory=store, scorer=nobody)
    assert rows() == first and list((tmp_path / "memory" / "runs").iterdir()) == []


def test_any_order_of_days_and_cars_gives_the_same_mart(spark, tmp_path):
    _write_raw(tmp_path, DAY, "a.json", [_post("x", comments=[("u", "저도 연비가 만족스럽습니다 정말")]), _post("y", "Venue"), _post("z", "Venue", title="오래된 제목")])
    _write_raw(tmp_path, NEXT, "a.json", [_post("x", title="새로운 제목"), _post("z", "Kona", title="코나 제목"), _post("z", "Venue", title="베뉴 제목")])
    stage = str(tmp_path / "stage")
    _run(spark, tmp_path, DAY, NEXT)
    score.run_scoring(spark, stage, DAY, NEXT)
    sources = spark.createDataFrame([("clien", "30s")], schemas.MART["tb_web_source"].schema)
    cars = spark.createDataFrame([("Kona", None, None), ("Venue", None, None)], schemas.MART["tb_car"].schema)
    orders = {
        "days": [(DAY, None), (NEXT, None)],
        "late day": [(NEXT, None), (DAY, None)],
        "cars": [(DAY, ["Venue"]), (DAY, ["Kona"]), (NEXT, ["Kona"]), (NEXT, ["Venue"])],
        "mixed": [(NEXT, ["Venue"]), (DAY, ["Kona"]), (NEXT, ["Kona"]), (DAY, ["Venue"]), (DAY, None)],
    }
    found = {}
    for name, loads in orders.items():
        mart = str(tmp_path / f"mart {name}")
        for day, some in loads:
            load.load_days(spark, stage, mart, cars, sources, day, cars=some)
        found[name] = {n: Counter(map(str, df.collect())) for n, df in _mart(spark, mart).items()}
        titles = {r.post_id: r.title for r in _mart(spark, mart)["tb_posts"].collect()}
        assert titles == {"x": "새로운 제목", "y": titles["y"], "z": "베뉴 제목"}
    assert all(f == found["days"] for f in found.values())


def test_a_new_car_reaches_the_days_already_loaded(spark, tmp_path):
    cars, sources = _days(spark, tmp_path)
    stage, mart = str(tmp_path / "stage"), str(tmp_path / "mart")
    for day in (DAY, NEXT):
        _run(spark, tmp_path, day)
        score.run_scoring(spark, stage, day)
    load.load_days(spark, stage, mart, cars.filter("car_name = 'Kona'"), sources, DAY)
    load.load_days(spark, stage, mart, cars, sources, NEXT)
    assert load.read_view(spark, mart, "vw_social_listening").count() == 10


def test_keys_of_a_rerun(spark, tmp_path):
    copies = [_post("k"), _post("k"), _post("v", "Venue"), _post("v", "Venue", title="다른 제목")]
    _write_raw(tmp_path, DAY, "a.json", copies)

    def keys():
        return {(r.post_id, r.title, r.post_uuid) for r in _table(spark, tmp_path, "post_data").collect()}

    _run(spark, tmp_path)
    first = keys()
    assert len(first) == 4
    _run(spark, tmp_path, cars=["Venue"])
    assert keys() == first
    raw = text_job.read_raw_days(spark, str(tmp_path / "raw"), [DAY]).repartition(7)
    text_job.run_text_job(spark, raw, str(tmp_path / "stage"), DAY)
    assert keys() == first


def test_shuffle_width_is_bounded_and_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(spark, 10**15) as width:
        assert width == session.MAX_PARTITIONS == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_validation_of_raw_files_and_stage_tables(spark, tmp_path):
    good, bad = _post("k", comments=[("u", "x")]), _post("v", like_count="5")
    _write_raw(tmp_path, DAY, "a.json", [good, bad])
    _write_raw(tmp_path, DAY, "b.json", {"no": "array"})
    rows = validate.raw_violations(spark, str(tmp_path / "raw" / "dt=*" / "*.json")).collect()
    assert [(r.pos, r.path, r.found) for r in rows if r.file.endswith("a.json")] == [(1, "root.like_count", "string")]
    assert any(r.file.endswith("b.json") for r in rows)
    (tmp_path / "lines.json").write_text(json.dumps(good) + "\n" + json.dumps(bad) + "\nnonsense\n", encoding="utf8")
    lines = validate.raw_violations(spark, str(tmp_path / "lines.json"), json_lines=True).collect()
    assert sorted(r.path for r in lines) == ["root", "root.like_count"]

    _write_raw(tmp_path, DAY, "b.json", [])
    _run(spark, tmp_path)
    stage = str(tmp_path / "stage")
    score.run_scoring(spark, stage, DAY)
    assert sorted(validate.stage_differences(spark, stage).select("table_name", "column").collect()) == []


def test_collect_and_retry(spark, tmp_path):
    good = PROFILE.format(comments=COMMENT.format(who="a", when="25.02.01 12:00", text="x"))
    broken = good.replace("25.02.01", "??")
    stored = frame(spark, ("/v?No=1", good), ("/v?No=2", broken), ("/v?No=3", "gone"))
    extract = partial(pages.profile_pages, car_name="Kona")
    out = str(tmp_path)
    collect.collect_pages(spark, stored, extract, out, DAY, "bobae")
    collect.retry_pages(spark, frame(spark, ("/v?No=2", good), ("/v?No=9", good)), extract, out, DAY, "bobae")
    raw = text_job.read_raw_days(spark, f"{out}/raw", [DAY, NEXT], json_lines=True)
    assert sorted((r.id, str(r.dt)) for r in raw.collect()) == [("bobae_1", DAY), ("bobae_2", DAY)]
    assert collect.still_missing(spark, out, DAY, "bobae").count() == 0


def test_prototype(spark, tmp_path):
    for source in ("youtube", "clien"):
        rows = [_post(f"{source}_1", comments=[("u", "투산산 정말 좋은 차 입니다 !!")])]
        (tmp_path / f"{source}_x.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf8")
    prototype.run_prototype(spark, str(tmp_path), "x.json", str(tmp_path / "out"))
    rows = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out" / "scored_csv")).collect()
    assert len(rows) == 8
    comment = next(r for r in rows if r.text.startswith("투싼"))
    assert (comment.view_count, comment.topic) == ("0", "기타")


def test_readers_and_writers(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([("a", "한글, \"q\"", [1, 2]), ("b", None, [])], "k string, v string, n array<int>")
    writers.write_json_lines(df, f"{base}/j")
    assert Counter(map(str, readers.read_json_lines(spark, f"{base}/j", df.schema).collect())) == Counter(map(str, df.collect()))
    assert "한글" in "".join(p.read_text(encoding="utf8") for p in (tmp_path / "j").glob("part-*"))
    writers.write_csv(df.drop("n"), f"{base}/c")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{base}/c")
    assert Counter(map(str, back.collect())) == Counter(map(str, df.drop("n").collect()))
    writers.write_files(spark.range(100).toDF("x"), f"{base}/f", 10)
    assert readers.input_files(spark.read.parquet(f"{base}/f")).count() == 10
    assert readers.read_columns(spark, f"{base}/f", ["x"]).count() == 100
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "failed_1.csv").write_text(" a \nb\n\n")
    (tmp_path / "l" / "failed_2.csv").write_text("a\nc\n")
    assert sorted(r.target for r in readers.read_failure_lists(spark, f"{base}/l/failed_*").collect()) == ["a", "b", "c"]
    assert [r.x for r in readers.read_lines(spark, f"{base}/l/failed_1.csv", "x").collect()] == ["a", "b"]
    assert writers.fill_missing_with_zero(spark.createDataFrame([(None, float("nan"))], "a int, b double")).first() == (0, 0.0)
    readers.register_staging(spark, {"posts": df})
    assert spark.table("staging_posts").count() == 2
    readers.drop_staging(spark)
    assert not spark.catalog.tableExists("staging_posts")


def test_snapshots(spark, tmp_path):
    base = str(tmp_path / "t")
    schema = spark.range(1).schema
    assert readers.read_snapshot(spark, base, schema).count() == 0
    writers.write_snapshot(spark.range(1), base, "2025-01-01")
    # The new version is computed from the one before and does not touch it.
    writers.write_snapshot(readers.read_snapshot(spark, base, schema).union(spark.range(5)), base, "2025-01-02")
    (tmp_path / "t" / "snapshot=2025-01-03").mkdir()  # an unfinished version
    assert readers.snapshot_ids(spark, base) == ["2025-01-01", "2025-01-02"]
    assert readers.read_snapshot(spark, base, schema).count() == 6
    assert readers.read_snapshot(spark, base, schema, before="2025-01-02").count() == 1


def test_stream_lands_each_record_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    first = spark.createDataFrame([record("p1"), record("p2", like_count=-1)], schemas.RAW)
    writers.write_json_lines(first, source)
    for _ in range(2):
        landing.land_stream(landing.raw_stream(spark, source), out, checkpoint, DAY).awaitTermination()
    spark.createDataFrame([record("p3")], schemas.RAW).write.mode("append").json(source)
    landing.land_stream(landing.raw_stream(spark, source), out, checkpoint, DAY).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.id, r.outcome) for r in rows) == [("p1", "good"), ("p2", "rejected"), ("p3", "good")]


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "a string, b int")
    assert load.measured_bytes(df) == 3 + 16 + 16
    assert load.is_small(df) and not load.is_small(df, limit=10)


def test_file_count_grows_with_the_data(spark):
    assert score.file_count(spark.range(100)) == 10
    assert score.file_count(spark.range(1000), rows_per_file=20) == 50


def test_days_between():
    days = text_job.days_between("2024-02-28", "2024-03-01")
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]
