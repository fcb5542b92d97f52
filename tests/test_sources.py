import tempfile
from datetime import datetime

import pytest

from corpusloom.operators import documents
from corpusloom.sources import backlog, result_tables, word_lists

PATHS = "year_month string, file_path string, job_id int"


def test_backlog_cycle(spark):
    registered = spark.createDataFrame(
        [("2015-06", "a", None), ("2015-06", "b", 7), ("2015-07", "a", None), ("2015-06", "", None)], PATHS
    )
    offered = spark.createDataFrame([("2015-06", "a"), ("2015-06", "c"), ("2015-06", "c")], "year_month string, file_path string")
    fresh = backlog.new_paths(registered, offered)
    assert [tuple(r) for r in fresh.collect()] == [("2015-06", "c", None)]
    paths = registered.unionByName(fresh)
    assert sorted(r.file_path for r in backlog.unclaimed(paths, "2015-06").collect()) == ["a", "c"]
    assert backlog.sample_unclaimed(paths, "2015-06", 1).count() == 1
    assert backlog.sample_unclaimed(paths, "2015-06", 0).count() == 2
    with pytest.raises(ValueError):
        backlog.sample_unclaimed(paths, "2015-06", 3)
    claims = spark.createDataFrame(
        [("2015-06", "a", 9, 2), ("2015-06", "a", 8, 1), ("2015-06", "b", 9, 2)],
        "year_month string, file_path string, job_id int, claim_no int",
    )
    claimed = {(r.year_month, r.file_path): r.job_id for r in backlog.claim(paths, claims).collect()}
    assert claimed == {
        ("2015-06", "a"): 8, ("2015-06", "b"): 7, ("2015-07", "a"): None, ("2015-06", ""): None, ("2015-06", "c"): None,
    }


def test_backlog_is_stored_by_month(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/paths"
    backlog.register(spark.createDataFrame([("2015-06", "a", None)], PATHS), path)
    backlog.register(spark.createDataFrame([("2015-07", "b", None)], PATHS), path)
    back = spark.read.parquet(path)
    assert [r.file_path for r in backlog.unclaimed(back, "2015-07").collect()] == ["b"]


def test_storing_a_job_again_replaces_it(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    def store(job, n):
        rows = spark.createDataFrame([(job, "English", n)], "job_id int, lang string, count bigint")
        result_tables.store(rows, root, "job_languages")

    store(1, 5), store(2, 6), store(1, 7), store(0, 1)
    table = result_tables.load(spark, root, "job_languages")
    assert sorted((r.job_id, r["count"]) for r in table.collect()) == [(0, 1), (1, 7), (2, 6)]
    assert result_tables.of_job(table, 0).count() == 0
    assert result_tables.key_violations(table, result_tables.KEYS["job_languages"]).count() == 0


def test_run_ledger(spark):
    t = [datetime(2024, 1, 1, 0, 0, s) for s in range(6)]
    events = [
        (1, t[0], 1, "STARTED", None), (1, t[3], 2, "COMPLETED", None),
        (2, t[1], 3, "STARTED", None), (2, t[4], 4, "ERROR", "disk"), (2, t[4], 5, "ERROR", "network"),
        (3, t[2], 6, "STARTED", None),
    ]
    df = spark.createDataFrame(events, "job_id bigint, ts timestamp, event_id bigint, status string, err_text string")
    got = {r.job_id: tuple(r)[1:] for r in result_tables.fold_run_events(df).collect()}
    assert got == {
        1: (t[0], t[3], "COMPLETED", None), 2: (t[1], t[4], "ERROR", "network"), 3: (t[2], None, "STARTED", None),
    }


def test_word_lists(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/words.txt", "w", encoding="utf-8") as out:
        out.write("﻿HEAD-TO-TOE\nBABY.com\nEPOETIN® alfa\nthe\nno\nbaby.com\n")
    got = sorted(r.term for r in word_lists.read_word_list(spark, folder).collect())
    assert got == ["alfa", "baby.com", "epoetin", "head-to-toe"]
    ordered = word_lists.read_ordered_word_list(spark, folder).orderBy("pos").collect()
    assert [r.term for r in ordered] == ["head-to-toe", "baby.com", "epoetin", "alfa"]
    assert word_lists.language_names(spark).count() == 185
    assert word_lists.excluded_words(spark).filter("term = 'website'").count() == 0
    assert word_lists.filter_words(spark).filter("term IN ('acuvue', 'zyrtec-d', 'sustenna')").count() == 3


def test_ordered_words_of_several_files(spark, tmp_path):
    lists = {"a.txt": ["apple", "pear", "apple"], "b.txt": [], "c.txt": ["fig", "pear", "plum"], "d.txt": ["cherry"]}
    for name, words in reversed(lists.items()):
        (tmp_path / name).write_text("".join(w + "\n" for w in words))
    plain = [w for name in sorted(lists) for w in lists[name]]
    for size in (0, 1, 3, 5, 6, 25_000):
        got = word_lists.read_ordered_word_list(spark, str(tmp_path), size).orderBy("pos").collect()
        assert [(r.term, r.pos) for r in got] == [(w, plain.index(w)) for w in dict.fromkeys(plain[:size])]


def test_keyword_filter(spark):
    texts = [(1, "fig once"), (2, "fig fig"), (3, "Fig and date-palm"), (4, ""), (5, "date-palm figs")]
    texts += [(1, "fig again"), (None, "fig fig"), (6, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    words = spark.createDataFrame([("fig",), ("date-palm",)], "term string")
    got = sorted(str(r.doc_id) for r in documents.with_keywords(docs, words).collect())
    assert got == ["2", "3", "None"]  # hits count within a row, repeated or null key or not
    assert documents.with_keywords(docs, words.limit(0)).count() == 0


def test_sample_is_about_its_share_and_repeatable(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    chosen = documents.sample_documents(docs, 100)
    assert 1700 < chosen.count() < 2300
    again = documents.sample_documents(docs.repartition(3), 100)
    assert chosen.exceptAll(again).count() == 0
    assert documents.sample_documents(docs, 1000).count() == 20_000
