"""Physical-plan properties: pushdown/pruning at the scan, one row shuffle for
cleaning + grouping, and the join paths beyond the broadcast size checks."""

import re

from threadloom.operators import authors, conversations
from threadloom.operators import sessionize as sz
from threadloom.sources import tables

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    from __spark_entry__ import queries
    p = _plan(queries()["messages_by_channel"](spark, SF001))
    assert "EqualTo(event_type,click)" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line]
    # the filter needs no event property but those the message view is built from
    assert scan and all("value" in line and "html" not in line for line in scan)
    urls = _plan(queries()["clean_urls"](spark, SF001))
    assert "Exchange" not in urls
    names = [line for line in _plan(queries()["real_name_default"](spark, SF001)).split("\n") if "FileScan" in line]
    assert names and all("ReadSchema: struct<c_custkey:bigint,c_name:string>" in line for line in names)


def test_one_shuffle_between_sessionize_and_conversations(spark):
    m = tables.event_messages(spark, SF001)
    s = sz.sessionize(m, order=["event_id"], thread="thread_ts")
    convs = conversations.clean_and_collect(s, tables.customer_users(spark, SF001))
    top = _plan(convs).split("Exchange hashpartitioning(_bk")[0]
    # above the sessionizer's exchange: exactly one exchange of the rows (by conversation)
    assert top.count("Exchange hashpartitioning(conv_id") == 1
    assert "SortMergeJoin" not in top


def test_join_paths_with_and_without_broadcast(spark):
    m = tables.event_messages(spark, SF001)
    users = tables.customer_users(spark, SF001)
    s = sz.sessionize(m, order=["event_id"], thread="thread_ts")

    def run():
        a = authors.resolve_author(m, users).select("event_id", "user_name")
        c = conversations.clean_and_collect(s, users).select("conv_id", "messages")
        return sorted(map(tuple, a.collect())), sorted((r.conv_id, str(r.messages)) for r in c.collect())

    small = run()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = run()
        p = _plan(authors.resolve_author(m, users))
        assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert small == big


def test_latest_file_decodes_its_files_once(spark):
    """The four passes over the decoded files read a written table; none parses the texts again."""
    from __spark_entry__ import queries
    plan = queries()["latest_file"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "from_json" not in plan and "collect_list" not in plan


def test_day_files_read_the_events_once(spark):
    """Both files of a day come from one scan; path rules are worked out per file, not per event."""
    from threadloom.plans import catalogue_export as ce
    m = tables.event_messages(spark, SF001)
    copies = ("/", None, None), ("/sub/", lambda event_id: event_id % 2 == 0, ce._broken())
    plan = ce._day_files(m, *copies)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [event_id") == 1 and plan.count("Aggregate [") == 1
    assert "UrlCodec" in plan and "UrlCodec" not in plan[plan.index("Aggregate ["):]


def test_day_files_of_odd_rows(spark):
    """Null ids are in no copy with a part, a day without even ids has no second file, days without a name have none."""
    from threadloom.plans import catalogue_export as ce
    rows = [(3, "a", "2024-01-01"), (2, "a", "2024-01-01"), (2, "a", "2024-01-01"), (None, "a", "2024-01-01"), (5, "b", "2024-01-03"),
            (None, "c", "2024-01-01"), (4, "d", "2024-01-03"), (6, None, "2024-01-01"), (8, "e", None)]
    m = spark.createDataFrame([(e, 1_500_000, c, d, "u", None, "x", False) for e, c, d in rows],
                              "event_id long, ts_us long, channel string, date string, user string, thread_ts string, text string, is_system boolean")
    got = ce._day_files(m, ("/", None, None), ("/sub/", lambda event_id: event_id % 2 == 0, ce._broken())).collect()
    ids = {r.rel_path: (re.findall(r'\{(?:"event_id":(\d+),)?', r.value), r.value.endswith("]]")) for r in got}
    assert len(got) == 6 and ids == {
        "a/2024-01-01.json": (["", "2", "2", "3"], False), "a/sub/2024-01-01.json": (["2", "2"], False), "b/2024-01-03.json": (["5"], False),
        "c/2024-01-01.json": ([""], False), "d/2024-01-03.json": (["4"], False), "d/sub/2024-01-03.json": (["4"], True)}


def test_latest_file_writes_a_row_per_message(spark):
    """No pass reads rows that hold whole files (their batches do not fit at size); few losing files are not shuffled for."""
    from __spark_entry__ import queries
    plan = queries()["latest_file"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "array<map" not in plan and "explode" not in plan and "best" not in plan
