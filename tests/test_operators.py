"""Edge cases of the telemetry operators on hand-written rows."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark import schemas as S
from ledgerspark.functions import columns as C
from ledgerspark.functions import identifiers as I
from ledgerspark.operators import gitlog as G
from ledgerspark.operators import joins as J
from ledgerspark.operators import loops as L
from ledgerspark.operators import merges as M
from ledgerspark.operators import quantiles as Q
from ledgerspark.operators import reviews as R
from ledgerspark.operators import sinks
from ledgerspark.operators import usage as U
from ledgerspark.operators.graph import connected_components
from ledgerspark.plans import registry
from ledgerspark.sources import git, logs, reviews, usage
from ledgerspark.sources.logs import parse_events
from ledgerspark.streaming import drains

D = dt.date
T = dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def shuffled(spark, call):
    """What ``call`` gives, and the rows and bytes that its stages shuffled."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    store, none = sc._jsc.sc().statusStore(), jvm.java.util.ArrayList()

    def stages():
        found = store.stageList(none, False, False, sc._gateway.new_array(jvm.double, 0), none)
        return {found.apply(i).stageId(): found.apply(i) for i in range(found.size())}

    before = set(stages())
    out = call()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    new = [s for k, s in stages().items() if k not in before]
    return out, sum(s.shuffleWriteRecords() for s in new), sum(s.shuffleWriteBytes() for s in new)


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("-srv-me-git-team-shop-feat-x-1", "shop"), ("git-team-europe-spain", "spain"), ("git_shop_sub", "shop_sub"), ("/srv_me_git_shop_sub", "shop"), ("town_hall", "town_hall"),
        ("shop-FIX-y", "shop"), ("spain/.wt/12", None), ("ab6f701adcaed79e9", None), ("2024-x", None), ("europe", None), ("holland", "netherlands"), ("asia/left-over", "left"),
        ("left-over", None), ("abcdefgh1/repo/europe/alps/tyrol", "tyrol"), (None, None), ("", None), ("polar/north/x", "arctic"), ("asia/japan/20", "japan"), ("europe/europe", None),
    ],
)
def test_canonical_project(spark, raw, want):
    assert one(spark, I.canonical_project(F.lit(raw).cast("string"))) == want


def test_session_ids(spark):
    t = F.lit("2024-01-02 03:04:05").cast("timestamp")
    null = F.lit(None).cast("string")
    assert one(spark, I.sanitize_session_id(F.lit("abc"), F.lit("p"), t)) == "abc"
    got = one(spark, I.sanitize_session_id(F.lit("/home/x"), null, F.lit(None).cast("timestamp")))
    assert got.startswith("sanitized@unknown@na@h") and len(got.rsplit("@h", 1)[1]) == 12
    assert one(spark, I.sanitize_session_id(null, F.lit("p"), t)) is None


def test_weeks_match_strftime(spark):
    start = D(2023, 12, 25)
    days = [(start + dt.timedelta(k),) for k in range(750)]
    df = spark.createDataFrame(days, "d date").select("d", C.iso_week("d").alias("i"), C.monday_week_of_year("d").alias("w"), C.sunday("d").alias("s"), C.monday("d").alias("m"))
    for r in df.collect():
        assert r["i"] == r["d"].strftime("%G-%V") and r["w"] == r["d"].strftime("%Y-W%W")
        assert r["s"].weekday() == 6 and 0 <= (r["d"] - r["s"]).days < 7 and r["m"].weekday() == 0


def test_jaccard_guards(spark):
    empty, a = F.array().cast("array<string>"), F.array(F.lit("x"), F.lit("y"))
    assert one(spark, C.jaccard(empty, empty)) == 1.0
    assert one(spark, C.jaccard(empty, a)) == 0.0
    assert one(spark, C.jaccard(a, F.array(F.lit("y"), F.lit("z")))) == pytest.approx(1 / 3)


def test_interval_join(spark):
    s = spark.createDataFrame([(1, "a", D(2024, 1, 3), D(2024, 1, 20), 5.0), (2, "a", D(2024, 1, 5), None, 5.0), (3, "b", D(2024, 1, 1), D(2024, 1, 1), 5.0), (4, "a", D(2024, 2, 2), D(2024, 2, 1), 5.0)], "session_id long, project string, start_date date, end_date date, duration_min double")
    c = spark.createDataFrame([("c1", "a", D(2024, 1, 3)), ("c2", "a", D(2024, 1, 20)), ("c3", "a", D(2024, 1, 21)), ("c4", "b", D(2024, 1, 1)), ("c5", "b", D(2024, 1, 3)), ("c6", None, D(2024, 1, 3))], "hash string, project string, date date")
    got = sorted((r["session_id"], r["hash"]) for r in J.session_commits(s, c).collect())
    assert got == [(1, "c1"), (1, "c2"), (3, "c4")]


def test_commits_of_a_busy_day_are_dealt_over_tasks(spark, monkeypatch):
    """300 sessions and 200 commits of one project and day, some of them twice, beside a quiet day: no task makes it all, no pair is lost or doubled."""
    monkeypatch.setattr(J, "SIDE", 32, raising=False)
    sessions = spark.createDataFrame([(i % 290, "p", D(2024, 1, 1), D(2024, 1, 2 + i % 2)) for i in range(300)], "session_id long, project string, start_date date, end_date date")
    commits = spark.createDataFrame([(f"c{k % 198}", "p", D(2024, 1, 2 if k < 200 else 3)) for k in range(205)], "hash string, project string, date date")
    made = J.session_commits(sessions, commits).select("session_id", "hash", "date", F.spark_partition_id().alias("task")).collect()
    want = [(i % 290, f"c{k % 198}", D(2024, 1, 2 if k < 200 else 3)) for i in range(300) for k in range(205) if k < 200 or i % 2]
    assert sorted((r["session_id"], r["hash"], r["date"]) for r in made) == sorted(want)
    tasks = [r["task"] for r in made]
    assert max(map(tasks.count, set(tasks))) < len(want) / 4


def test_sessions_without_an_end_of_days(spark):
    """A session of all dates has rows for the days between the first and the last commit only; no commits, no rows."""
    s = spark.createDataFrame([(1, "a", D(1, 1, 1), D(9999, 12, 31)), (2, "a", D(9999, 1, 1), D(9999, 12, 31)), (3, "b", D(2024, 1, 2), D(9999, 12, 31))], "session_id long, project string, start_date date, end_date date")
    c = spark.createDataFrame([("c1", "a", D(2024, 1, 1)), ("c2", "a", D(2024, 1, 3)), ("c3", "b", D(2024, 1, 1)), ("c4", "b", D(2024, 1, 3)), ("c5", "a", None)], "hash string, project string, date date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    try:
        got, records, _ = shuffled(spark, lambda: J.session_commits(s, c).select("session_id", "hash").collect())
        none = J.session_commits(s, c.where("false")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got)) == [(1, "c1"), (1, "c2"), (3, "c4")] and none == []
    assert records < 100


def test_attribution_drops_sessions_without_minutes(spark):
    s = spark.createDataFrame([(D(2024, 1, 1), "a", 30.0), (D(2024, 1, 1), "b", None), (D(2024, 1, 1), None, 10.0), (D(2024, 1, 2), "a", 0.0)], "date date, project string, duration_min double")
    d = spark.createDataFrame([(D(2024, 1, 1), 8.0), (D(2024, 1, 2), 5.0)], "date date, cost double")
    assert [tuple(r) for r in J.attribute(d, s, ["cost"], 4).collect()] == [(D(2024, 1, 1), "a", 6.0, 30.0, 0.75)]


def test_all_null_costs(spark):
    rows = spark.createDataFrame([(D(2024, 1, 1), None, "m", "s", 1, 2, None)], "date date, project string, model string, source string, input_tokens long, output_tokens long, cost double")
    assert U.turn_daily(rows).first()["cost"] is None
    assert U.cost_by_model_day(rows.withColumn("total_tokens", F.lit(1))).first()["cost"] == 0.0


def test_gaps_and_coupling(spark):
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 5),), (D(2024, 1, 5),)], "date date")
    assert [tuple(r) for r in U.activity_gaps(days).collect()] == [(D(2024, 1, 3), D(2024, 1, 4), 2)]
    assert U.activity_gaps(days.limit(1)).collect() == []
    files = [("p", h, f) for h in range(3) for f in ("A", "a", "b")] + [("p", 9, f"f{i:02d}") for i in range(25)] * 3
    got = J.change_coupling(spark.createDataFrame(files, "project string, hash long, file string"), least=1).collect()
    assert {(r["file_a"], r["file_b"]) for r in got if r["n"] == 3} == {("A", "a"), ("A", "b"), ("a", "b")}
    assert sum(r["file_a"].startswith("f") for r in got) == 97


def test_latest_snapshot_keeps_ties(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("a", 2, 7)], "k string, at int, v int")
    assert sorted(r["v"] for r in G.latest_per_key(rows, ["k"], "at").collect()) == [6, 7]


def events(spark, payloads):
    import json

    lines = [(json.dumps({"ts": f"2024-01-01T00:00:{k:02d}Z", "host": "h", "payload": p}), "f", k) for k, p in enumerate(payloads)]
    return parse_events(spark.createDataFrame([*lines, ("  ", "f", 98), ("{bad", "f", 99)], "value string, file string, line int"))


STOP = {"event_type": "session_stop", "session_id": "s1", "project": "shop", "started_at": "2024-01-01T00:00:00Z"}


def test_append_sessions_is_idempotent_and_last_wins(spark):
    e = events(spark, [STOP | {"agent": "x"}, STOP | {"agent": "y"}, STOP | {"session_id": None}, STOP | {"session_id": "-Users-me-x"}, STOP | {"session_id": "s2", "project": "secret_lab"}, {"event_type": "other"}])
    old = S.empty(spark, S.SESSIONS).drop("trigger")
    first = M.append_sessions(old, e, "2024-01-02 00:00:00")
    got = {r["session_id"]: r for r in first.collect()}
    assert got["s1"]["agent"] == "y" and got["s1"]["trigger"] == "unknown" and len(got) == 2
    again = M.append_sessions(first, e, "2024-01-03 00:00:00")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    shortened = first.withColumn("session_id", F.regexp_replace("session_id", "@h[0-9a-f]{12}$", ""))
    assert M.append_sessions(shortened, e, "2024-01-03 00:00:00").count() == 2


def test_chat_files_hold_many_messages(spark, monkeypatch):
    from ledgerspark.plans import files

    made, plain = [], files._documents
    monkeypatch.setattr(files, "_documents", lambda df, name: made.append(df.count()) or plain(df, name))
    sf = "/root/testdata/sf0.01"
    assert registry.queries()["s08_chat_logs"](spark, sf).agg(F.sum("n")).first()[0] == 8000
    assert made == [20]  # 10,000 events of 20 users: no more files than users below 40,000 rows


def test_events_are_parsed_once_and_new_rows_read_twice_are_staged(spark):
    e = events(spark, [STOP, {"event_type": "cost_emitted", "project": "shop", "date": "2024-01-01", "source": "a"}, {"event_type": "git_commit", "project": "shop", "hash": "h1"}])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    now, parse = "2024-01-02 00:00:00", "from_json("
    for rows in (M.sessions_from_events, M.costs_from_events, M.commits_from_events):
        text = plan(rows(e, now))
        assert rows(e, now).count() == 1 and text.count(parse) == 1
        assert text.count("left-over") <= plan(e.select(I.canonical_project("payload.project"))).count("left-over")  # one canonical name
    for append, ddl in ((M.append_sessions, S.SESSIONS), (M.append_costs, S.COSTS), (M.append_commits, S.COMMITS)):
        out = append(S.empty(spark, ddl), e, now)
        assert out.count() == 1 and parse not in plan(out)


def test_appends_do_not_depend_on_order(spark):
    cost = [{"event_type": "cost_emitted", "project": "shop", "date": "2024-01-01", "source": s, "daily_cost_usd": v} for s, v in (("a", 1.0), ("b", 2.0), ("a", 3.0), (None, 9.0))]
    a = M.append_costs(S.empty(spark, S.COSTS), events(spark, cost), "2024-01-02 00:00:00")
    b = M.append_costs(S.empty(spark, S.COSTS), events(spark, cost).orderBy(F.desc("line")), "2024-01-02 00:00:00")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 2
    commit = [{"event_type": "git_commit", "project": "shop", "hash": "h1", "lines_added": 2, "lines_deleted": 3}, {"event_type": "git_commit", "project": "shop", "hash": ""}]
    c = M.append_commits(S.empty(spark, S.COMMITS), events(spark, commit), "2024-01-02 00:00:00").collect()
    assert [(r["commit_pk"], r["lines_changed"]) for r in c] == [("shop|h1", 5)]


def test_additive_merge_of_nulls(spark):
    ddl = "k string, n long, cost double, lo int, hi int, name string"
    old = spark.createDataFrame([("a", 1, None, 3, 4, "o"), ("b", 1, 2.0, 3, 4, "o"), (None, 1, 1.0, 3, 4, "o"), ("d", 5, None, 1, 2, "o")], ddl)
    new = spark.createDataFrame([("a", 2, None, 1, 9, None), ("b", 2, None, 1, 9, "n"), (None, 2, 1.0, 1, 9, "n"), ("e", 7, 1.5, 1, 2, "n")], ddl)
    got = {r["k"]: tuple(r)[1:] for r in M.additive_merge(old, new, ["k"], ["n"], ["lo"], ["hi"], ["name"], ["cost"]).collect()}
    assert got == {"a": (3, None, 1, 9, "o"), "b": (3, 2.0, 1, 9, "n"), None: (3, 2.0, 1, 9, "n"), "d": (5, None, 1, 2, "o"), "e": (7, 1.5, 1, 2, "n")}


def test_numbers_are_gapless(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    got = sorted(r["n"] for r in M.numbered(rows, ["a", "b"], "n", 16).collect())
    assert got == list(range(1, 1001))


def test_acknowledge_unknown_hash(spark):
    loops = S.empty(spark, S.LOOPS)
    with pytest.raises(KeyError):
        M.acknowledge(loops, "x", "me", "why", "2024-01-01")


def brute_components(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(7)
    edges = {"path": [(i, i + 1) for i in range(40)], "star": [(99, i) for i in range(60)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)], "empty": []}[shape]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (5, 5), (None, 3)], "src long, dst long")).collect()}
    want = brute_components([e for e in edges if e[0] != e[1]])
    assert got == want


def finding(k, text, minutes, severity="high", file="a.py"):
    return (k, severity, file, text, T(2024, 1, 1) + dt.timedelta(minutes=minutes))


FIND = "job_id long, severity string, primary_file string, problem_text string, reviewed_at timestamp"
RUN = "agent_type string, started_at timestamp, commit_sha string, total_cost_usd double"


def test_loop_tiers(spark):
    rows = [finding(k, "the same problem again", 10 * k) for k in range(4)] + [finding(50 + k, "other thing entirely", 10 * k, file="b.py") for k in range(3)]
    runs = [("fixer", T(2024, 1, 1) + dt.timedelta(minutes=10 * k + 5), f"c{k}", 1.5) for k in range(3)] + [("reader", T(2024, 1, 1), "z", 9.0)]
    out = L.detect_loops(spark.createDataFrame(rows, FIND), spark.createDataFrame(runs, RUN)).collect()
    assert [(r["cycles"], r["tier"], r["primary_file"], r["fix_commit_shas"], r["estimated_wasted_usd"]) for r in out] == [(3, "watch", "a.py", "c0,c1,c2", 4.5)]
    free = L.detect_loops(spark.createDataFrame(rows, FIND), None).collect()
    assert [(r["cycles"], r["estimated_wasted_usd"]) for r in free] == [(3, None)]
    none = L.detect_loops(spark.createDataFrame(rows, FIND), spark.createDataFrame([], RUN)).collect()
    assert [(r["cycles"], r["fix_commit_shas"], r["estimated_wasted_usd"]) for r in none] == [(3, "", 0.0)]


def test_cycles_against_plain_loops(spark):
    """Gaps of minutes to months, runs on their very ends, hashes of one or two cycles."""
    rng = random.Random(8)
    rows, runs, at = [], [], T(2024, 1, 1)
    for h in range(30):
        now = at + dt.timedelta(minutes=rng.randint(0, 3000))
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows), f"h{h}", now))
            now += dt.timedelta(microseconds=rng.choice([0, 1, 10**6, 10**9, 4 * 10**9, 10**11, 5 * 10**11, 3 * 10**12]))
    times = [r[2] for r in rows]
    for k in range(400):
        t = rng.choice(times) if k % 3 == 0 else at + dt.timedelta(seconds=rng.randint(0, 80 * 86400))
        runs.append((rng.choice(["fixer", "reader"]), t, rng.choice([None, f"c{k % 9}"]), rng.choice([None, 0.5, 2.0])))
    want = {}
    for h in {r[1] for r in rows}:
        mine = sorted((t, k) for k, g, t in rows if g == h)
        n, shas, cost = 0, set(), 0.0
        for (a, _), (b, _) in zip(mine, mine[1:]):
            hit = [r for r in runs if r[0] == "fixer" and a <= r[1] <= b]
            n += bool(hit)
            shas |= {r[2] for r in hit if r[2]}
            cost += sum(r[3] or 0.0 for r in hit)
        if n:
            want[h] = (n, ",".join(sorted(shas)), round(cost, 6))
    got = L.cycles(spark.createDataFrame(rows, "job_id long, content_hash string, reviewed_at timestamp"), spark.createDataFrame(runs, RUN)).collect()
    assert {r["content_hash"]: (r["cycles"], r["fix_commit_shas"], r["estimated_wasted_usd"]) for r in got} == want
    assert {1, 2} <= {v[0] for v in want.values()}


@pytest.mark.parametrize(
    ("cwd", "want"),
    [
        ("/srv/me/git/shop/foo/bar", "shop"), ("/srv/me/git/europe/alps/tyrol/x", "tyrol"), ("/srv/me/git/shop/src/git/inner", "shop"), ("/srv/me/git/2024/.git", "me"),
        ("/opt/w/site", "site"), ("/opt/w/.cache/12", "w"), ("/git/europe", None), ("", None), (None, None),
    ],
)
def test_project_of_directory(spark, cwd, want):
    assert one(spark, I.project_of_directory(F.lit(cwd).cast("string"))) == want


def _tied(nodes, edges):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        top[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("hot,block", [(64, 512), (2, 512), (2, 3), (5, 8)])
def test_similar_edges_tie_what_all_pairs_tie(spark, hot, block):
    """Families, chains and unlike sets of few words in two groups, with every token hot or none."""
    rng = random.Random(hot + block)
    rows = []
    for k in range(150):
        base = [f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 6))] if k % 3 else [f"f{k % 4}{j}" for j in range(8)]
        if k % 3 == 0:
            base[rng.randrange(8)] = f"x{k}"
        rows.append((rng.choice("gh"), f"n{k}", sorted(set(base))))
    got = L.similar_edges(spark.createDataFrame(rows, "g string, node string, tok array<string>"), ["g"], 0.6, hot=hot, block=block).collect()
    same = lambda a, b: a[0] == b[0] and a[2] and b[2] and len(set(a[2]) & set(b[2])) / len(set(a[2]) | set(b[2])) >= 0.6
    want = [(a[1], b[1]) for a in rows for b in rows if a[1] < b[1] and same(a, b)]
    assert {tuple(sorted(r)) for r in got} <= {tuple(sorted(w)) for w in want}  # only true links
    assert _tied([r[1] for r in rows], got) == _tied([r[1] for r in rows], want)


def test_many_near_copies_give_few_rows(spark, monkeypatch):
    """20,000 near copies in one group: stars in proportion to them, and no block is compared."""
    n = 20_000
    words = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.concat(F.lit("w"), i.cast("string")))
    nodes = spark.range(n).select(F.lit("g").alias("g"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("node"), F.array_append(words, F.concat(F.lit("own"), F.col("id").cast("string"))).alias("tok"))
    compared = []
    between = L._between_stars

    def watched(*args):
        out = between(*args)
        compared.append(out.count())
        return out

    monkeypatch.setattr(L, "_between_stars", watched)
    edges = L.similar_edges(nodes, ["g"], 0.6)
    assert edges.count() <= (L.PIVOTS + 1) * n and compared == [0]
    assert edges.select(F.explode(F.array("a", "b")).alias("x")).distinct().count() == n


def test_lines_are_not_shuffled_to_their_splits(spark, tmp_path):
    """Numbers of lines come from frames of one row a split, which are sent to the lines."""
    from ledgerspark.sources.lines import placed_lines

    spark.createDataFrame([(f"l{k}",) for k in range(200)], "value string").coalesce(1).write.text(str(tmp_path / "t"))
    lines = placed_lines(spark, str(tmp_path / "t"))
    assert [r["line"] for r in lines.orderBy("line").collect()] == list(range(1, 201))
    plan = lines._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_unlike_sets_with_common_words_are_not_paired(spark, monkeypatch):
    """2,000 sets of 30 of 150 words each, and 40 copies with a word changed: few rows a set are staged, all links are kept."""
    rng = random.Random(8)
    sets = [sorted(rng.sample([f"w{k}" for k in range(150)], 30)) for _ in range(2000)]
    sets += [sorted([*s[1:], f"x{k}"]) for k, s in enumerate(sets[:40])]
    rows = [("g", f"n{k}", s) for k, s in enumerate(sets)]
    staged, keep = [], L.stage

    def counted(df, label):
        out = keep(df, label)
        staged.append(out.count())
        return out

    monkeypatch.setattr(L, "stage", counted)
    got = L.similar_edges(spark.createDataFrame(rows, "g string, node string, tok array<string>"), ["g"], 0.6, block=400).collect()
    assert sum(staged) < 5 * len(rows)
    assert {frozenset(r) for r in got} >= {frozenset((f"n{k}", f"n{2000 + k}")) for k in range(40)}
    apart = [frozenset((a[1], b[1])) for a in rows for b in rows if a[1] < b[1] and len(set(a[2]) & set(b[2])) >= 0.375 * 60]
    assert {frozenset(r) for r in got} == set(apart)


def test_words_travel_once_to_their_block(spark, monkeypatch):
    """600 unlike sets in several blocks and 30 copies with a word changed and four more: blocks meet by sketches, all links are kept."""
    rng = random.Random(5)
    sets = [sorted(rng.sample([f"w{k}" for k in range(4000)], rng.randint(30, 60))) for _ in range(600)]
    sets += [sorted([*s[1:], f"x{k}", *(f"y{k}_{j}" for j in range(4))]) for k, s in enumerate(sets[:30])]
    rows = [("g", f"n{k}", s) for k, s in enumerate(sets)]
    read, tied = [], L._tied

    def counted(whole, limit):
        read.append(whole.count())
        return tied(whole, limit)

    monkeypatch.setattr(L, "_tied", counted)
    got = L.similar_edges(spark.createDataFrame(rows, "g string, node string, tok array<string>"), ["g"], 0.6, block=100).collect()
    assert {frozenset(r) for r in got} == {frozenset((f"n{k}", f"n{600 + k}")) for k in range(30)}
    assert sum(read) == len(rows)


def test_sets_that_sketches_cannot_part_are_compared_whole(spark, monkeypatch):
    """400 sets just below the limit and ten pairs above it: pairs of blocks with too many such pairs go by their words, no link is lost or made."""
    core = [f"c{k}" for k in range(29)]
    sets = [[*core, *(f"o{k}_{j}" for j in range(11))] for k in range(400)]
    sets += [[*core, *(f"o{k}_{j}" for j in range(5)), *(f"p{k}_{j}" for j in range(7))] for k in range(10)]  # 34 of 47
    rows = [("g", f"n{k}", sorted(s)) for k, s in enumerate(sets)]
    read, tied = [], L._tied

    def counted(whole, limit):
        read.append(whole.count())
        return tied(whole, limit)

    monkeypatch.setattr(L, "_tied", counted)
    got = L.similar_edges(spark.createDataFrame(rows, "g string, node string, tok array<string>"), ["g"], 0.6, block=100).collect()
    assert len(read) == 2 and {frozenset(r) for r in got} == {frozenset((f"n{k}", f"n{400 + k}")) for k in range(10)}


def test_clean_projects(spark):
    names = ["cash-book", "Cash-BOOK-feat-x", "shop-fix-9", "p3", "P3-docs-y", "p11", "p11-feat-a", "Mixed", None, "shop-feature"]
    clean = lambda xs, column="name": I.clean_projects(spark.createDataFrame([(n, 1) for n in xs], f"{column} string, n int"), "name", (("cash-book", "ledger"), ("p11", "p10")))
    got = [r["name"] for r in clean(names).collect()]
    assert got == ["ledger", "ledger", "shop-fix-9", "p10", "p10", "Mixed", None, "shop-feature"]
    # rows of an alias join those of its project, none is lost
    assert clean(["cash-book", "ledger", "cash-book-ci-2"]).groupBy("name").agg(F.sum("n").alias("n")).collect() == [("ledger", 3)]
    # names that only begin like a denied one stay; denied ones go whatever their branch
    assert [r["name"] for r in clean(["p30", "p3x-feat-a", "secret_labs", "SECRET_LAB-perf-b", "secret_lab-perf"]).collect()] == ["p30", "p3x-feat-a", "secret_labs", "secret_lab-perf"]
    assert clean([]).collect() == [] and clean(["p3", "x"], "repo").count() == 2


def test_collapse_is_transitive_and_stays_in_its_group(spark):
    a, b, c = "one two three four five six seven", "one two three four five six eight", "two three four five six eight nine ten"
    rows = [finding(1, a, 1), finding(2, b, 2), finding(3, c, 3), finding(4, a, 4, file="z.py"), finding(5, "", 5), finding(6, None, 6), finding(7, "unlike", 7)]
    df = spark.createDataFrame(rows, FIND).withColumn("content_hash", C.finding_hash("severity", "primary_file", "problem_text"))
    before = {r["job_id"]: r["content_hash"] for r in df.collect()}
    got = {r["job_id"]: r["content_hash"] for r in L.collapse(df).collect()}
    assert got[1] == got[2] == got[3] == before[1]
    assert got[4] != got[1] and got[5] == got[6] and got[7] == before[7] and len(got) == 7


def test_findings_are_collapsed_whole(spark, tmp_path):
    """Old findings, words after character 60 and the whole project count; against plain loops."""
    rng = random.Random(4)
    words = [a + b + c for a in "bdklm" for b in "aeiou" for c in ("rt", "ns", "lp", "x")]
    head, bodies = " ".join(words[:20]), [rng.sample(words[20:], 40) for _ in range(60)]
    rows = []
    for i in range(1500):
        body = list(rng.choice(bodies))
        body[rng.randrange(40)] = f"w{i}"
        rows.append((i, f"{head} {' '.join(body)}" if i % 2 else f"{' '.join(body)} {head}", "en", ["src1", "src10", "src11"][i % 3]))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["job_id"]: r["content_hash"] for r in registry.queries()["u13_near_duplicate_collapse"](spark, str(tmp_path)).collect()}
    kind = ["high", "medium", "low", "critical", "odd"]
    own = [hashlib.md5("\x1f".join([kind[i % 5], s, " ".join(t.split()[:12])]).encode()).hexdigest() for i, t, _, s in rows]
    sets, up = [set(t.split()) for _, t, _, _ in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a % 15, a, 15):  # equal id modulo 15: one severity and source
            if own[a] == own[b] or len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    assert got == {i: own[top(i)] for i in range(len(rows))}  # the first seen has the least id
    assert len(set(got.values())) > 15 and len(set(got.values())) < len(set(own))


def test_blocklist_query_takes_whole_texts(spark, tmp_path):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in range(30)]
    docs = [(i, " ".join(words[:15] + rng.sample(words[15:], 20)), "en", f"src{i % 20}") for i in range(120)]
    bench = [(k, " ".join(docs[3 * k][1].split()[14:])) for k in range(30)] + [(600, None), (601, "the of")]
    docs.append((121, "", "en", "other"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").where("text IS NOT NULL").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {tuple(r) for r in registry.queries()["j14_blocklist_matches_all"](spark, str(tmp_path)).collect()}
    tokens = lambda t: set(t.split()) - {"the", "of"}
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    want = {(i, k) for i, t, _, s in docs for k, b in bench if b is not None and (s == f"src{k % 500}" or like(tokens(t), tokens(b)) >= 0.5)}
    assert got == {(i, hashlib.md5(str(k).encode()).hexdigest()) for i, k in want}
    assert (121, 601) in want and len(want) > 120


def test_open_trend_equals_counting(spark):
    rng = random.Random(3)
    base = T(2024, 1, 1)
    rows = []
    for k in range(300):
        a = base + dt.timedelta(hours=rng.randint(0, 900))
        b = None if rng.random() < 0.3 else a + dt.timedelta(hours=rng.randint(-20, 400))
        rows.append((k, a, b))
    got = R.open_trend(spark.createDataFrame(rows, "review_id long, created_at timestamp, closed_at timestamp"), "2024-01-31", 14).collect()
    assert len(got) == 14 and any(b is not None and b < a for _, a, b in rows)
    for r in got:
        assert r["open_at_end"] == sum(a.date() <= r["date"] and (b is None or b.date() > r["date"]) for _, a, b in rows)
        assert r["opened"] == sum(a.date() == r["date"] for _, a, _ in rows)
        assert r["closed"] == sum(b is not None and b.date() == r["date"] for _, _, b in rows)
    reasons = spark.createDataFrame([(*r, ["done", "", None][k % 3]) for k, r in enumerate(rows)], "review_id long, created_at timestamp, closed_at timestamp, why string")
    for r in R.open_trend(reasons, "2024-01-31", 14, reason="why").collect():
        assert r["closed"] == sum(k % 3 == 0 and b is not None and b.date() == r["date"] for k, (_, _, b) in enumerate(rows))
        assert r["open_at_end"] == sum(a.date() <= r["date"] and (b is None or k % 3 > 0 or b.date() > r["date"]) for k, (_, a, b) in enumerate(rows))


def test_all_contributors(spark):
    rows = [("p", f"a{k:02d}", D(2024, 1, 1)) for k in range(12) for _ in range(12 - k)]
    got = {r["author"]: r["share"] for r in G.contributors(spark.createDataFrame(rows, "project string, author string, date date")).collect()}
    assert len(got) == 12 and got["a11"] is None and got["a10"] is None
    assert got["a00"] == round(12 / sum(range(3, 13)), 6)


REPORT = """intro
- **Severity**: High
- **Location**: `src/a.py:42-67`; b.py
- **Problem**: it breaks
- **Fix**: mend it
---
**Severity**: low
**Problem**: no place
----
**Location**: c.py:7
**Problem**: no severity
"""


def test_review_reports(spark):
    df = spark.createDataFrame([(1, REPORT), (2, ""), (3, None)], "job_id long, output string")
    got = sorted(map(tuple, reviews.parse_findings(df).collect()))
    assert got == [(1, "high", "src/a.py", "src/a.py:42-67; b.py", "it breaks", "mend it"), (1, "low", None, None, "no place", None)]
    odd = "**Problem**: two\n  lines: here\n- **Severity**: Low (maybe)\n- **Fix**: one\n\nmore\n## Next\ntext\n- **Problem**: again"
    r = reviews.parse_findings(spark.createDataFrame([(1, odd)], "job_id long, output string")).first()
    assert (r["severity"], r["problem_text"], r["fix_text"], r["primary_file"]) == ("low", "two\n  lines: here", "one\n\nmore", None)
    loc = sorted(map(str, (tuple(r) for r in reviews.review_locations(df, ["job_id"]).collect())))
    assert loc == sorted(["(1, 'src/a.py', None)", "(1, 'c.py', 7)"])


def test_git_dumps(spark):
    dump = "a" * 40 + "|2024-01-02|fix: a|b\n\n3\t1\tx.py\n-\t-\tbin.png\n" + "b" * 40 + "|2024-01-03|empty\n"
    lines = [("p", "f", k // 2, k, x) for k, x in enumerate(["before", *dump.split("\n")])]  # blocks of two lines: entries go over their borders
    d = git.under_headers(spark.createDataFrame(lines, "project string, file string, block long, n long, line string"))
    assert sorted(map(tuple, git.commits(d).collect())) == [("p", "a" * 7, D(2024, 1, 2), "fix: a|b", 3, 1, 2), ("p", "b" * 7, D(2024, 1, 3), "empty", 0, 0, 0)]
    assert [tuple(r) for r in git.file_touches(d).collect()] == [("p", "a" * 7, D(2024, 1, 2), "x.py", 3, 1)]


def test_turn_lines(spark):
    tid = "0123456789abcdef0123-0123456789ab-cde"[:36]
    line = f"2024-01-01T01:02:03.5Z x{{thread.id={tid} model=m1}} codex.turn.token_usage.input_tokens=10 codex.turn.token_usage.cached_input_tokens=4 codex.turn.token_usage.total_tokens=12"
    df = spark.createDataFrame([(line,), ("no marker",), ("codex.turn.token_usage.total_tokens=1",)], "value string")
    r = logs.parse_turns(df).collect()
    assert len(r) == 1 and r[0]["non_cached_input_tokens"] == 6 and r[0]["model"] == "m1" and r[0]["output_tokens"] is None


def test_model_lists(spark):
    f = lambda x: one(spark, usage.as_list(F.lit(x).cast("string")))
    assert (f(None), f("null"), f("text"), f('"text"'), f('["a","b"]')) == ([], [], ["text"], ["text"], ["a", "b"])


def test_gates(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([("p3", "/home/x"), ("ok", "/y")], "project string, working_dir string")
    with pytest.raises(sinks.GateError):
        sinks.publish_gate(df, ["project"])
    assert sinks.publish_gate(I.drop_confidential(df, ["project"]), ["project"]).columns == ["project"]
    assert sinks.write_table(df, path) == 2
    with pytest.raises(sinks.GateError):
        sinks.write_table(df.limit(1), path, allow_shrink=False)
    assert sinks.read_table(spark, path, "project string, extra int").count() == 2
    with pytest.raises(sinks.GateError):
        sinks.require_complete(sinks.completeness({"none": df.limit(0)}, {}))


def test_tables_never_seem_empty(spark, tmp_path, monkeypatch):
    """A writer that stops anywhere leaves the old version; appends write only new rows; a second writer fails."""
    import os

    path, ddl = f"file://{tmp_path}/t", "k long"
    assert sinks.write_table(spark.range(5).withColumnRenamed("id", "k"), path) == 5
    with monkeypatch.context() as m:
        m.setattr(sinks, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            sinks.write_table(spark.range(9).withColumnRenamed("id", "k"), path)
    assert sinks.read_table(spark, path, ddl).count() == 5
    old = sinks.version_of(spark, path)
    assert sinks.append_table(spark.range(5, 8).withColumnRenamed("id", "k"), path, {"batch": 3}) == 8
    assert sorted(r["k"] for r in sinks.read_table(spark, path, ddl).collect()) == list(range(8))
    new = sinks.version_of(spark, path)
    assert new.parts[:1] == old.parts and len(new.parts) == 2 and new.notes == {"batch": 3}
    with pytest.raises(sinks.GateError):
        sinks._publish(spark, path, old, [], 0, {})
    before = set(os.listdir(tmp_path / "t"))
    with pytest.raises(sinks.GateError):
        sinks.write_table(spark.range(1).withColumnRenamed("id", "k"), path, allow_shrink=False)
    assert {n for n in os.listdir(tmp_path / "t") if not n.startswith(".")} <= before  # refused rows are gone
    assert sinks.compact_table(spark, path, ddl, parts=1) and len(sinks.version_of(spark, path).parts) == 1
    sinks.vacuum_table(spark, path)
    assert sinks.read_table(spark, path, ddl).count() == 8
    assert len([n for n in os.listdir(tmp_path / "t") if not n.startswith(".")]) == 2


def test_staged_events_are_event_files_only(spark, tmp_path):
    assert logs.read_staged_events(spark, f"file://{tmp_path}/absent").collect() == []
    (tmp_path / "in").mkdir()
    assert logs.read_staged_events(spark, f"file://{tmp_path}/in").collect() == []
    for name in ("events-1.jsonl", "notes.txt", "events.jsonl.bak"):
        (tmp_path / "in" / name).write_text('{"ts": "2024-01-01T00:00:00Z", "host": "' + name + '", "payload": {}}\n')
    assert [r["host"] for r in logs.read_staged_events(spark, f"file://{tmp_path}/in").collect()] == ["events-1.jsonl"]


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    from ledgerspark.operators import lineage

    class Cluster:
        conf = spark.conf

        class sparkContext:
            master = "yarn"

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            lineage.shared_dir(Cluster)
    staged = lineage.stage(spark.range(3), "x")
    assert staged.count() == 3
    lineage.discard(staged, spark.range(1))
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|PATH_NOT_FOUND"):
        spark.read.parquet(staged._staged_at).count()


def test_confidential_rows_of_null_projects_stay(spark):
    df = spark.createDataFrame([(None,), ("Secret_Lab",), ("PRIVATE_x",), ("fine",)], "project string")
    assert sorted(str(r["project"]) for r in I.drop_confidential(df, ["project", "absent"]).collect()) == ["None", "fine"]


def test_streaming_drain_twice(spark, tmp_path):
    import json
    import os

    os.makedirs(tmp_path / "in")

    def put(name, payloads):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"ts": "2024-01-01T00:00:00Z", "payload": p}) for p in payloads) + "\n{bad\n")

    put("events-1.jsonl", [STOP, STOP | {"session_id": "s2"}])
    root, mark = f"file://{tmp_path}/store", f"file://{tmp_path}/mark"
    drains.drain(spark, f"file://{tmp_path}/in", root, mark, "2024-01-02 00:00:00").awaitTermination()
    put("events-2.jsonl", [STOP, STOP | {"session_id": "s3"}])
    drains.drain(spark, f"file://{tmp_path}/in", root, mark, "2024-01-02 00:00:00").awaitTermination()
    ids = sorted(r["session_id"] for r in sinks.read_table(spark, f"{root}/sessions", S.SESSIONS).collect())
    assert ids == ["s1", "s2", "s3"]


def _parts(spark, path):
    return sorted(p.rows for p in sinks.version_of(spark, path).parts)


def test_stored_rows_come_under_new_rules(spark, tmp_path):
    """Rows stored before a rule was made: without triggers, with home folders; the second drain opens nothing."""
    path = f"file://{tmp_path}/store/sessions"
    old = spark.createDataFrame([("a", "/Users/someone/code/x", 1.0), ("b", "/tmp/y", 2.0), ("c", None, 3.0)], "session_id string, working_dir string, duration_min double")
    sinks.write_table(old, path)
    sinks.append_table(old.limit(1).withColumns({"session_id": F.lit("d"), "trigger": F.lit("scheduled"), "working_dir": F.lit("/home/me/z")}), path)
    events = parse_events(spark.createDataFrame([('{"ts": "2024-01-01T00:00:00Z", "payload": {"event_type": "session_stop", "session_id": "%s", "working_dir": "/home/me/w"}}' % k, "f", n) for n, k in enumerate("ae")], "value string, file string, line int"))
    want = [("a", "code/x", "unknown"), ("b", "y", "unknown"), ("c", None, "unknown"), ("d", "z", "scheduled"), ("e", "w", "unknown")]
    for _ in range(2):
        drains.drain_batch(events, f"file://{tmp_path}/store", "2024-01-02 00:00:00")
        got = sinks.read_table(spark, path, S.SESSIONS).select("session_id", "working_dir", "trigger").collect()
        assert sorted(map(tuple, got)) == want
        version = sinks.version_of(spark, path)
        assert all(p.rules == tuple(r.name for r in M.SESSION_RULES) for p in version.parts)
        assert sinks.migrate_table(spark, path, S.SESSIONS, M.SESSION_RULES) == 0 and sinks.version_of(spark, path) == version
    one_more = (*M.SESSION_RULES, sinks.Rule("no-agents", lambda df: df.withColumn("agent", F.lit(None).cast("string"))))
    assert sinks.migrate_table(spark, path, S.SESSIONS, one_more) == 5
    assert sorted(map(tuple, sinks.read_table(spark, path, S.SESSIONS).select("session_id", "working_dir", "trigger").collect())) == want


def test_only_parts_without_the_rule_are_read(spark, tmp_path):
    import shutil

    path, ddl = f"file://{tmp_path}/t", "k long"
    up = sinks.Rule("up", lambda df: df.withColumn("k", F.col("k") + 100))
    sinks.append_table(spark.range(3).withColumnRenamed("id", "k"), path, rules=["up"])
    sinks.append_table(spark.range(3, 5).withColumnRenamed("id", "k"), path)
    under = sinks.version_of(spark, path).parts[0]
    shutil.move(f"{tmp_path}/t/{under.name}", f"{tmp_path}/away")  # reading it would fail
    assert sinks.migrate_table(spark, path, ddl, [up]) == 2
    shutil.move(f"{tmp_path}/away", f"{tmp_path}/t/{under.name}")
    assert sorted(r["k"] for r in sinks.read_table(spark, path, ddl).collect()) == [0, 1, 2, 103, 104]
    assert sinks.version_of(spark, path).parts[0] == under


def test_merging_by_size_writes_few_rows(spark, tmp_path):
    """N appends of like size: N log N rows written, few parts left, nothing lost."""
    import math

    path, ddl, n = f"file://{tmp_path}/t", "k long", 40
    written = 0
    for k in range(n):
        written += 3 + 0 * sinks.append_table(spark.range(3 * k, 3 * k + 3).withColumnRenamed("id", "k").coalesce(1), path)
        written += sinks.merge_tiers(spark, path, ddl)
        sinks.vacuum_table(spark, path)
        assert len(sinks.version_of(spark, path).parts) <= 3 * 4
        assert len([x for x in (tmp_path / "t").iterdir() if x.is_dir()]) == len(sinks.version_of(spark, path).parts)
    assert sorted(r["k"] for r in sinks.read_table(spark, path, ddl).collect()) == list(range(3 * n))
    assert written <= 3 * n * (1 + math.log(3 * n, 4)) and sum(_parts(spark, path)) == 3 * n


def test_merge_plans_move_parts_up():
    parts = lambda *rows: [sinks.Part(f"p{k}", n) for k, n in enumerate(rows)]
    plan = lambda *rows: sorted(sorted(p.rows for p in g) for g in sinks.merge_plan(parts(*rows)))
    assert plan() == plan(5, 5, 5, 100) == []
    assert plan(5, 5, 5, 5, 100) == [[5, 5, 5, 5]]
    assert plan(1, 1, 1, 1, 4, 4, 4, 16, 16, 16) == [[1, 1, 1, 1, 4, 4, 4, 16, 16, 16]]  # each tier fills the next
    assert plan(0, 0, 0, 0) == [[0, 0, 0, 0]]


def test_old_parts_stay_for_their_readers(spark, tmp_path):
    import os
    import time

    path, ddl = f"file://{tmp_path}/t", "k long"
    rows = lambda a, b: spark.range(a, b).withColumnRenamed("id", "k")
    sinks.write_table(rows(0, 2), path)
    reader = sinks.read_table(spark, path, ddl)
    sinks.write_table(rows(0, 5), path)
    sinks._write_part(rows(0, 9), path)  # a writer at work
    assert sinks.vacuum_table(spark, path, keep_hours=1) == 0 and reader.count() == 2
    for x in (tmp_path / "t").iterdir():
        os.utime(x, (time.time() - 7200,) * 2)
    assert sinks.vacuum_table(spark, path, keep_hours=1) == 3  # the first version, its part, and the one of no version
    assert sinks.read_table(spark, path, ddl).count() == 5


def test_appends_of_nothing_leave_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    sinks.append_table(spark.range(2), path)
    old, files = sinks.version_of(spark, path), set((tmp_path / "t").iterdir())
    assert sinks.append_table(spark.range(0), path) == 2
    assert sinks.version_of(spark, path) == old and {x for x in (tmp_path / "t").iterdir() if x.suffix != ".crc"} == {x for x in files if x.suffix != ".crc"}
    assert sinks.append_table(spark.range(0), path, {"batch": 4}) == 2
    assert sinks.version_of(spark, path).notes == {"batch": 4} and sinks.version_of(spark, path).parts == old.parts


def test_version_files_that_are_not_whole(spark, tmp_path, monkeypatch):
    """Readers pass over them; a writer waits until they are surely left behind."""
    path = f"file://{tmp_path}/t"
    sinks.append_table(spark.range(2), path)
    (tmp_path / "t" / "version-000000000002").write_text('{"parts": [')
    assert sinks.version_of(spark, path).number == 1
    with pytest.raises(sinks.GateError):
        sinks.append_table(spark.range(2), path)
    monkeypatch.setattr(sinks, "STOPPED_MINUTES", -1)
    assert sinks.append_table(spark.range(3), path) == 5 and sinks.version_of(spark, path).number == 2


def test_stored_ids_are_found_by_both_spellings(spark):
    line = lambda k, i: ('{"ts": "2024-01-01T00:00:00Z", "payload": {"event_type": "session_stop", "session_id": "%s", "project": "shop", "started_at": "2024-01-01T00:00:00Z"}}' % i, "f", k)
    events = parse_events(spark.createDataFrame([line(0, "/home/a"), line(1, "/home/b"), line(2, "plain"), line(3, "new")], "value string, file string, line int"))
    ids = {r["session_id"] for r in M.sessions_from_events(events, "2024-01-02 00:00:00").collect()}
    a = next(i for i in ids if i.endswith(hashlib.md5(b"/home/a").hexdigest()[:12]))
    old = spark.createDataFrame([("plain",), (a,)], "session_id string")
    got = {r["session_id"] for r in M.new_sessions(old, events, "2024-01-02 00:00:00").collect()}
    assert got == ids - {"plain", a} and len(got) == 2
    short = spark.createDataFrame([(a.rsplit("@h", 1)[0],)], "session_id string")  # fits both sanitised ids
    assert {r["session_id"] for r in M.new_sessions(short, events, "2024-01-02 00:00:00").collect()} == {"plain", "new"}


@pytest.mark.parametrize("cell,bins", [(4096, 1024), (3, 256)])
def test_quantiles_are_exact(spark, cell, bins):
    """Groups of one value, many, ties, outliers of any size, NULL keys and values; against sorted lists."""
    import numpy as np

    rng = random.Random(cell)
    groups = {
        "one": [4.5], "same": [7.0] * 50, "two": [1.0, 2.0], "many": [rng.gauss(0, 1) for _ in range(300)], "ties": [float(rng.randrange(4)) for _ in range(200)],
        "far": [10.0**k for k in range(-6, 9)] * 3 + [-1e9, 1e12], "next": [1.0, 1.0 + 2**-52, 1.0 + 2**-51] * 9, None: [float(k) for k in range(101)], "null": [None] * 5,
    }
    rows = [(k, 1, v) for k, vs in groups.items() for v in [*vs, None]]
    rng.shuffle(rows)
    shares = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    got = {r["g"]: r["q"] for r in Q.quantiles(df, ["g", "h"], "v", shares, cell=cell, bins=bins).collect()}
    assert set(got) == set(groups) - {"null"}
    for g, q in got.items():
        assert np.allclose(q, np.quantile(groups[g], shares), rtol=1e-12, atol=0)
    assert np.allclose(Q.quantiles(df, [], "v", shares, cell=cell, bins=bins).first()["q"], np.quantile([v for vs in groups.values() for v in vs if v is not None], shares))
    assert [r["q"] for r in Q.quantiles(df.where("g = 'null'"), [], "v", shares).collect()] == [None]
    assert Q.quantiles(df.where("g = 'null'"), ["g"], "v", shares).collect() == []


def test_quantile_rounds_hold_little(spark, monkeypatch):
    """No round groups more than its bins; values are listed only where few are left."""
    n, staged = 200_000, {}
    stage = Q.stage

    def watched(df, label):
        out = stage(df, label)
        staged.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(Q, "stage", watched)
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7.0).alias("v"))
    want = sorted(r["v"] for r in df.collect())
    assert Q.quantiles(df, [], "v", [0.5, 0.9], cell=16, bins=64).first()["q"] == pytest.approx([(want[n // 2 - 1] + want[n // 2]) / 2, want[int(0.9 * (n - 1))] + 0.1 * (want[int(0.9 * (n - 1)) + 1] - want[int(0.9 * (n - 1))])])
    assert max(staged["quantile-ranks"]) <= 4 and len(staged["quantile-ranks"]) <= 12


def test_a_commit_gives_its_first_files(spark):
    files = [("p", "c1", f"f{k:03d}") for k in range(200)] * 2 + [("p", "c2", f"f{k:03d}") for k in range(30)] + [("p", "c3", f"f{k:03d}") for k in range(5, 8)] + [("q", "c1", "only")]
    df = spark.createDataFrame(files, "project string, hash string, file string")
    got = {(r["file_a"], r["file_b"]): r["n"] for r in J.change_coupling(df, least=2, top=1000).collect()}
    want = {(f"f{a:03d}", f"f{b:03d}"): 3 if 5 <= a and b < 8 else 2 for a in range(20) for b in range(a + 1, 20)}
    assert got == want
    plan = J.change_coupling(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # below the exchange and above


def _turn(thread, tokens):
    tid = f"{thread:08d}-0000-0000-0000-000000000000"
    return f"2024-01-01T01:02:03.5Z x{{thread.id={tid} model=m}} codex.turn.token_usage.input_tokens=1 codex.turn.token_usage.total_tokens={tokens}\n"


def test_log_tail_counts_each_line_once(spark, tmp_path):
    """Rotations, growth, lines that are not ended, a file begun anew, and a copy of nothing."""
    import os

    logs, table = tmp_path / "logs", f"file://{tmp_path}/rollup"
    logs.mkdir()
    live = logs / "tui.log"

    def tail(**more):
        return drains.tail_turns(spark, f"file://{logs}", table, keep_hours=0.0, **more)

    live.write_text(_turn(1, 10) + _turn(1, 20))
    (logs / "empty.log").write_text("")
    assert tail() == 2 and tail() == 2
    with live.open("a") as f:  # it grows, its last line is not ended
        f.write(_turn(2, 30) + _turn(2, 4)[:-2])
    assert tail() == 3
    with live.open("a") as f:
        f.write("40\n")
    assert tail() == 4
    os.rename(live, logs / "tui.log.1")  # rotated twice, with a short new file in between
    live.write_text(_turn(3, 50))
    assert tail() == 5
    os.rename(logs / "tui.log.1", logs / "tui.log.2")
    os.rename(live, logs / "tui.log.1")
    live.write_text(_turn(3, 50) + _turn(3, 60))  # begins like the one before it: taken for it, grown
    assert tail(files_per_batch=1) == 6
    live.write_text(_turn(4, 1) + _turn(4, 2))  # begun anew under its name
    assert tail() == 8
    got = {r["thread_id"][:8]: (r["n_turns"], r["total_tokens"]) for r in drains.turn_rollup(spark, table).collect()}
    assert got == {"00000001": (2, 30), "00000002": (2, 30 + 40), "00000003": (2, 110), "00000004": (2, 3)}
    version = sinks.version_of(spark, table)
    assert tail() == 8 and sinks.version_of(spark, table) == version  # nothing new writes nothing
    assert [x.name for x in (tmp_path / "rollup-tailed").iterdir()] == [version.notes["tailed"]]


def test_blocks_without_state_count_late_rows(spark, tmp_path):
    """Ten batches: no state in the stream, few parts in the table; rows behind the watermark are corrections, none is lost."""
    src, table, mark = tmp_path / "src", f"file://{tmp_path}/blocks", f"file://{tmp_path}/mark"
    src.mkdir()
    ddl = "ts timestamp, total_tokens long, cost double"
    times = [T(2024, 1, 1 + d, 6 * (d % 4), 30) for d in range(9)]
    batches = [[(t, 10, 1.0), (t, 5, 0.5)] for t in times] + [[(T(2024, 1, 1, 1), 7, 2.0), (times[8], 1, 0.25), (None, 3, None)]]
    want, late = {}, {}
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"file://{src}")
        q = drains.drain_blocks(spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"file://{src}"), table, mark, late_hours=24.0, keep_hours=0.0)
        q.awaitTermination()
        assert q.exception() is None and all(not p.stateOperators for p in q.recentProgress)
        for t, tokens, _ in rows:
            block = t and t.replace(hour=t.hour // 5 * 5, minute=0)
            want[block] = want.get(block, 0) + tokens
            if k == 9 and t == T(2024, 1, 1, 1):
                late[block] = tokens
        assert len(sinks.version_of(spark, table).parts) <= 6
    assert {r["block_start"]: r["tokens"] for r in drains.blocks_of(spark, table).collect()} == want
    assert {r["block_start"]: r["tokens"] for r in drains.late_corrections(spark, table).collect()} == late
    again = drains.drain_blocks(spark.readStream.schema(ddl).parquet(f"file://{src}"), table, mark, keep_hours=0.0)
    again.awaitTermination()
    assert sum(r["n"] for r in drains.blocks_of(spark, table).collect()) == 21


def test_upserts_write_only_touched_buckets(spark, tmp_path):
    """One key on 64 buckets: one bucket is read and written; the others need not even be there. A NULL key, deletes, other numbers of buckets."""
    import shutil

    path, ddl = f"file://{tmp_path}/t", "k long, v string"
    frame = lambda rows: spark.createDataFrame(rows, ddl)
    put = lambda rows, **more: sinks.upsert_table(frame(rows), path, ddl, ["k"], lambda old, new: M.replace_by_key(old, new, ["k"]), **more)
    stored = lambda: sorted(((r["k"], r["v"]) for r in sinks.read_table(spark, path, ddl).collect()), key=str)
    want = {k: "old" for k in [*range(1000), None]}
    assert put([(k, "old") for k in want]) == 1001
    before = sinks.version_of(spark, path)
    assert {p.bucket for p in before.parts} == set(range(64)) and before.rows == 1001
    bucket = one(spark, F.pmod(F.xxhash64(F.lit(7).cast("long")), F.lit(64)))
    part = {p.bucket: p for p in before.parts}
    aside = [p for b, p in part.items() if b != bucket]
    for p in aside:
        shutil.move(f"{tmp_path}/t/{p.name}", f"{tmp_path}/aside-{p.bucket}")
    assert put([(7, "new")]) == part[bucket].rows
    for p in aside:
        shutil.move(f"{tmp_path}/aside-{p.bucket}", f"{tmp_path}/t/{p.name}")
    want[7] = "new"
    assert stored() == sorted(want.items(), key=str) and set(aside) < set(sinks.version_of(spark, path).parts)
    assert put([(2000, "more")]) < 100
    want[2000] = "more"
    assert put([]) == 0 and stored() == sorted(want.items(), key=str) and sinks.version_of(spark, path).rows == len(want)
    sinks.vacuum_table(spark, path)
    assert stored() == sorted(want.items(), key=str) and not (tmp_path / "t" / part[bucket].name).exists()
    gone = sinks.upsert_table(frame([(3, "x")]), path, ddl, ["k"], lambda old, new: old.join(new, "k", "left_anti"))
    want.pop(3)
    assert gone < 100 and stored() == sorted(want.items(), key=str)
    assert put([(1, "again")], buckets=4) == len(want) and len(sinks.version_of(spark, path).parts) == 4
    want[1] = "again"
    assert stored() == sorted(want.items(), key=str)


def test_lines_have_one_number_however_files_are_cut(spark, tmp_path):
    from ledgerspark.sources.lines import placed_lines

    text = {"a.log": [f"line {k} " + "x" * (k % 50) for k in range(400)], "b.log": ["only"], "c.log": []}
    for name, ls in text.items():
        (tmp_path / name).write_text("".join(x + "\n" for x in ls))
    dump = "".join(f"{k:040x}|2024-01-02|m\n\n" + "".join(f"{j}\t1\tf{j}.py\n" for j in range(60)) for k in range(12))
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "p.txt").write_text(dump)
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1k", "300"):
            spark.conf.set(key, size)
            placed = placed_lines(spark, [f"file://{tmp_path}/{n}" for n in text])
            dumps = git.read_dumps(spark, f"file://{tmp_path}/g")
            spark.conf.set(key, "777")  # a second scan would be cut otherwise
            assert sorted((r["name"], r["line"], r["value"]) for r in placed.collect()) == sorted((n, k + 1, x) for n, ls in text.items() for k, x in enumerate(ls))
            got = git.commits(dumps).collect()
            assert sorted(r["hash"] for r in got) == sorted(f"{k:040x}"[:7] for k in range(12)) and {(r["lines_added"], r["files_changed"]) for r in got} == {(sum(range(60)), 60)}
    finally:
        spark.conf.set(key, old)


def test_block_triggers_and_metrics(spark):
    at = lambda h, m=0: T(2024, 1, 1, h, m)
    rows = [(1, at(1), at(2), at(6), False, 10, 2.0), (2, at(6, 30), None, at(11), False, 10, 2.0), (3, at(1), at(1), at(6), False, 10, 2.0), (4, at(1), at(2), at(6), True, 10, 2.0)]
    b = spark.createDataFrame(rows, "block_id int, start_time timestamp, actual_end timestamp, planned_end timestamp, is_gap boolean, total_tokens long, cost double")
    got = {r["block_id"]: r["trigger"] for r in U.block_trigger(b, [(0, 7)]).collect()}
    assert got == {1: "scheduled", 2: "interactive", 3: "scheduled", 4: "scheduled"}
    m = {r["block_id"]: (r["hours"], r["cost_per_hour"]) for r in U.block_metrics(b).collect()}
    assert m == {1: (1.0, 2.0), 2: (4.5, round(2 / 4.5, 6)), 3: (0.0, None)}


def test_blocklist(spark):
    p = spark.createDataFrame([(1, "fix the broken parser now", ["x.py"]), (2, "", None), (3, "nothing alike", None)], "prompt_id long, text string, files array<string>")
    b = spark.createDataFrame([("h1", "x.py", "unrelated words"), ("h2", "y.py", "broken parser fix"), ("h3", "z.py", "the of")], "content_hash string, primary_file string, summary string")
    assert sorted(map(tuple, J.blocklist_matches(p, b).collect())) == [(1, "h1"), (1, "h2"), (2, "h3")]


SESSION = "session_id string, duration_min double, project string, start_date date, end_date date"


def test_findings_of_long_sessions(spark):
    """Sessions of a day to centuries, before 1970 too, repeated and without ends, against plain loops."""
    rng = random.Random(5)
    day = lambda n: D(1970, 1, 1) + dt.timedelta(days=n)
    sessions = []
    for k in range(60):
        a = rng.randint(-1500, 2500)
        sessions.append((f"s{k % 50}", float(rng.choice([0, 30, 60])), rng.choice(["p", "q", None]), day(a), day(a + rng.choice([0, 1, 31, 32, 33, 63, 1023, 1024, 2100, 90000]))))
    sessions += [("none", 5.0, "p", None, day(3)), ("open", 5.0, "p", day(3), None), ("turned", 5.0, "p", day(9), day(3)), ("ever", 5.0, "p", D(1, 1, 1), D(9999, 12, 31))]
    commits = [(rng.choice(["p", "q", None]), rng.choice([None, *map(day, range(-1500, 2600, 9))]), f"c{rng.randint(0, 40)}") for _ in range(700)]
    reviews = [(k if k % 7 else None, f"c{rng.randint(0, 60)}") for k in range(90)]
    want = {}
    for s, minutes, p, a, b in sessions:
        if minutes > 0 and a and b:
            n = sum(1 for q, d, c in set(commits) if p and q == p and d and a <= d <= b for i, h in reviews if i is not None and h == c)
            want[s, round(minutes / 60, 3)] = want.get((s, round(minutes / 60, 3)), 0) + n
    frames = spark.createDataFrame(sessions, SESSION), spark.createDataFrame(commits, "project string, date date, commit_sha string"), spark.createDataFrame(reviews, "review_id long, commit_sha string")
    assert {(r[0], r[1]): r[2] for r in J.findings_per_session(*frames).collect()} == {k: n for k, n in want.items() if n}


def test_findings_of_a_busy_day_are_not_paired(spark):
    """400 sessions and 400 commits of one project and day: 160,000 pairs."""
    sessions = spark.range(400).selectExpr("concat('s', id) AS session_id", "5D AS duration_min", "'p' AS project", "DATE'2024-01-01' AS start_date", "DATE'2024-01-02' AS end_date")
    commits = spark.range(400).selectExpr("'p' AS project", "DATE'2024-01-02' AS date", "concat('c', id) AS commit_sha")
    reviews = spark.range(400).selectExpr("id AS review_id", "concat('c', id) AS commit_sha")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    try:
        got, records, _ = shuffled(spark, lambda: J.findings_per_session(sessions, commits, reviews).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 400 and {r["n_findings"] for r in got} == {400}
    assert records < 10_000


def test_findings_by_length_reads_sessions_once(spark):
    sessions = spark.range(5000).repartition(3, "id").selectExpr("id % 12 + 0.5D AS hours", "id % 7 AS n_findings")
    got, records, _ = shuffled(spark, lambda: J.findings_by_length(sessions).collect())
    assert {(r["length"], r["n_sessions"]) for r in got} == {("<1", 417), ("1-3", 834), ("3-8", 2085), (">8", 1664)} and {r["median_findings"] for r in got} == {3.0}
    assert records < 6000


def test_blocklist_against_all_pairs(spark):
    """Ids of several texts, copies, NULL and empty texts, prompts far longer than any entry; no row per token of these."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    prompts = [(k % 90, " ".join(rng.sample(words, rng.randint(1, 14))), [f"f{k % 60}"]) for k in range(150)]
    prompts += [(k, prompts[3][1], []) for k in range(200, 210)] + [(300, None, ["f1"]), (301, "", None), (302, "the of", [])]
    prompts += [(400 + k, " ".join(f"w{j}" for j in range(400)), None) for k in range(50)]
    entries = [(f"h{k % 25}", f"f{2 * k}", " ".join(rng.sample(words, rng.randint(1, 14)))) for k in range(30)] + [("none", "g", None), ("empty", "g", "of")]
    tokens = lambda t: None if t is None else set(t.split()) - {"the", "of"}
    like = lambda a, b: a is not None and b is not None and (not a and not b or bool(a | b) and len(a & b) / len(a | b) >= 0.5)
    want = {(i, h) for i, t, fs in prompts for h, f, s in entries if f in (fs or []) or like(tokens(t), tokens(s))}
    p = spark.createDataFrame(prompts, "prompt_id long, text string, files array<string>")
    b = spark.createDataFrame(entries, "content_hash string, primary_file string, summary string")
    got, records, _ = shuffled(spark, lambda: J.blocklist_matches(p, b).collect())
    assert sorted(map(tuple, got)) == sorted(want)
    assert records < 10_000
