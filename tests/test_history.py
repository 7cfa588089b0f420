"""Versions, as-of joins, lifetimes, quarantine, pseudonyms and alerts against plain versions."""

import hashlib
import hmac
import random
from datetime import datetime, timedelta

import pytest
from helpers import LIKE, POST, event, messages, rows, subject, uri

from eventlake.functions import pseudonyms
from eventlake.operators import alerts, bronze, history, quarantine
from eventlake.tables import Catalog

CHANGES = "actor_did string, at_us long, event_kind string, handle string, is_active boolean, status string"


def changes(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        who, at = r.choice("abc"), r.randrange(40) * 1_000_000
        out.append((who, at, "identity", r.choice("xyz"), None, None) if r.random() < 0.5 else (who, at, "account", None, *r.choice([(True, None), (False, "gone")])))
    return out


def plain_versions(given):
    out = []
    for who in sorted({c[0] for c in given}):
        state, starts = (None, None, None), []
        own = sorted({c for c in given if c[0] == who}, key=lambda c: (c[1], c[2], c[3] or "", c[4] or False, c[5] or ""))
        for k, (_, at, kind, handle, active, status) in enumerate(own):
            state = (handle, *state[1:]) if kind == "identity" else (state[0], active, status)
            if k + 1 < len(own) and own[k + 1][1] == at:
                continue
            if not starts or starts[-1][1] != state:
                starts.append((at, state))
        at = lambda us: datetime(1970, 1, 1) + timedelta(microseconds=us)
        out += [(who, k + 1, *s, at(t), at(starts[k + 1][0]) if k + 1 < len(starts) else None) for k, (t, s) in enumerate(starts)]
    return sorted(out, key=str)


def test_versions_have_no_gaps_and_late_changes_split_them(spark, tmp_path):
    given = changes(1, 60)
    table = Catalog(spark, f"file://{tmp_path}").table("dim_actor_versions", {"bucket": "CAST(pmod(xxhash64(actor_did), 4) AS INT)"})
    for part in (given[:30], given[30:50], given[50:]):  # times are in no order, so later parts fall into earlier stretches
        so_far = spark.createDataFrame(given[: given.index(part[-1]) + 1] if part is not given[50:] else given, CHANGES)
        history.refresh_versions(table, spark.createDataFrame(part, CHANGES), so_far)
    history.refresh_versions(table, spark.createDataFrame(given[-3:] * 2, CHANGES), spark.createDataFrame(given * 2, CHANGES))  # redelivered
    found = rows(table.read())
    assert found == plain_versions(given)
    by = {}
    for r in sorted(found, key=lambda r: (r[0], r[1])):
        if r[0] in by:
            assert by[r[0]] == r[5]
        by[r[0]] = r[6]
    assert set(by.values()) == {None}


def test_versions_of_nothing_and_of_nulls(spark):
    assert history.actor_versions(spark.createDataFrame([], CHANGES)).count() == 0
    odd = [(None, 1, "identity", "x", None, None), ("a", None, "identity", "x", None, None), ("a", 5, "identity", None, None, None)]
    assert [tuple(r)[:3] for r in history.actor_versions(spark.createDataFrame(odd, CHANGES)).collect()] == [("a", 1, None)]


def test_as_of_takes_the_last_version_before_each_fact(spark):
    r = random.Random(2)
    versions = plain_versions(changes(3, 50))
    facts = [(k, r.choice(["a", "b", "c", "d", None]), datetime(1970, 1, 1) + timedelta(seconds=r.randrange(45))) for k in range(80)]
    v = spark.createDataFrame(versions, "actor_did string, version long, handle string, is_active boolean, status string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    found = history.as_of(spark.createDataFrame(facts, "id int, who string, at timestamp_ntz"), v, "who", "at", ["version", "handle"])
    expected = []
    for k, who, at in facts:
        last = max((x for x in versions if x[0] == who and x[5] <= at), key=lambda x: x[5], default=None)
        expected.append((k, who, at, *(last[1:3] if last else (None, None))))
    assert rows(found) == sorted(expected, key=str)


def test_lifetimes_pair_in_time_order_and_counts_follow(spark):
    up = [("u1", "like", "p", 10), ("u1", "like", "p", 12), ("u1", "like", "p", 30), ("u2", "like", "p", 15), ("u3", "repost", "q", 5), (None, "like", "p", 1), ("u5", "like", None, 3)]
    down = [("u1", 20), ("u1", 25), ("u2", 15), ("u4", 9), ("u3", 1)]
    moves = history.transitions(spark.createDataFrame(up, "record_uri string, kind string, target string, jetstream_time_us long"), spark.createDataFrame(down, "record_uri string, jetstream_time_us long"))
    at = lambda us: datetime(1970, 1, 1) + timedelta(microseconds=us)
    lived = history.lifetimes(moves)
    assert rows(lived, "record_uri", "started_at", "ended_at") == sorted([("u1", at(10), at(20)), ("u1", at(30), None), ("u2", at(15), at(15)), ("u3", at(5), None), ("u5", at(3), None)], key=str)
    assert rows(history.net_counts(lived)) == sorted([("p", "like", at(10), 1), ("p", "like", at(20), 0), ("p", "like", at(30), 1), ("q", "repost", at(5), 1)], key=str)


BAD = [
    event(1, "did:a", "create", POST, "p", 0, text="fine"), event(2, "nobody", "create", POST, "p", 1), event(3, "did:a", "create", "app.other", "p", 2), event(4, "did:a", "rename", POST, "p", 3),
    event(5, "did:a", "create", LIKE, "", 4, subject=subject(uri("did:b", "x"))), event(6, "did:a", "create", POST, "q", 5, "not-a-time"), event(7, "did:a", "create", POST, "r", 6, None),
    event(8, "did:a", "create", POST, "s", 7, "2031-01-01T00:00:00Z"), event(9, "did:a", "delete", POST, "s", 8), event(10, "nobody", "create", "app.other", "", 9, "never"),
]


def test_quarantine_keeps_every_row_on_one_side_with_all_reasons(spark, tmp_path):
    commits = bronze.family(bronze.to_bronze(messages(spark, BAD)), "commit")
    judged = quarantine.judged(commits)
    reasons = {r.offset: r.reasons for r in quarantine.rejected(judged).collect()}
    assert set(reasons) == {2, 3, 4, 5, 6, 7, 8, 10}
    assert reasons[2] == ["no actor"] and reasons[4] == ["unknown operation"] and reasons[6] == ["malformed client time"] and reasons[7] == ["no client time"] and reasons[8] == ["client time after receipt"]
    assert reasons[10] == ["no actor", "unknown collection", "no record key", "malformed client time"]
    assert rows(quarantine.accepted(judged), "offset") == [(1,), (9,)] and quarantine.accepted(judged).columns == commits.columns
    n = dict(map(tuple, quarantine.counts(judged).collect()))
    assert (n["read"], n["accepted"], n["rejected"]) == (10, 2, 8)
    lake = Catalog(spark, f"file://{tmp_path}")
    write = quarantine.quarantine_batch(lake, "gate")
    for k, part in enumerate((commits.where("offset < 6"), commits.where("offset >= 6"), commits.where("offset < 6"))):
        write(part, k % 2)  # the first batch is delivered twice
    assert tuple(quarantine.conserved(lake, commits).first()) == (10, 2, 8, True)
    assert tuple(quarantine.conserved(lake, commits.limit(9)).first())[3] is False


def test_pseudonyms_equal_hmac_and_joins_and_sums_stay(spark):
    keys = {1: b"k", 2: b"l" * 64, 3: b"m" * 100}
    names = ["did:a", "did:b", "", "did:é日本", "did:a"]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)] + [(None, 9)], "did string, n int")
    for version, key in keys.items():
        found = {r.n: r.did for r in pseudonyms.renamed(df, ["did"], keys, version).collect()}
        assert found == {k: f"v{version}:" + hmac.new(key, n.encode(), hashlib.sha256).hexdigest() for k, n in enumerate(names)} | {9: None}
    old, new = pseudonyms.renamed(df, ["did"], keys, 1), pseudonyms.renamed(df, ["did"], keys)
    bridge = pseudonyms.rotation(df, "did", keys, 1, 3)
    assert rows(pseudonyms.rekeyed(old, "did", bridge)) == rows(new)
    sums = lambda x: sorted(r[1] for r in x.groupBy("did").sum("n").collect())
    assert sums(df) == sums(old) == sums(new) and df.join(df.withColumnRenamed("n", "m"), "did").count() == old.join(old.withColumnRenamed("n", "m"), "did").count()


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_over_a_filled_grid(spark, seed):
    r, t0 = random.Random(seed), datetime(2024, 5, 1)
    n = {k: max(0, int(r.gauss(4, 2))) + (30 if k in (20, 21, 40) else 0) for k in range(60)}
    given = [("s", t0 + timedelta(hours=k), v) for k, v in n.items() if v and k % 7] + [("t", t0, 1), ("t", t0 + timedelta(hours=30), 50)]
    grid = alerts.filled(spark.createDataFrame(given, "series string, bucket timestamp_ntz, n long"), "series", "1 HOUR")
    levels = alerts.levels(grid, "series")
    seen = {(x[0], x[1]): x[2] for x in given}
    expected, found = [], {(x.series, x.bucket): x for x in levels.collect()}
    for series, length in (("s", max(k for k in n if n[k] and k % 7) + 1 - min(k for k in n if n[k] and k % 7)), ("t", 31)):
        first = min(b for s, b in seen if s == series)
        values = [seen.get((series, first + timedelta(hours=k)), 0) for k in range(length)]
        on = False
        middle = lambda x: (sorted(x)[(len(x) - 1) // 2] + sorted(x)[len(x) // 2]) / 2
        for k, v in enumerate(values):
            back = values[max(0, k - alerts.BACK) : k]
            if len(back) >= alerts.LEAST:
                m = middle(back)
                score = (v - m) / max(1.0, alerts.SCALE * middle([abs(x - m) for x in back]))
                on = True if score >= alerts.OPEN else False if score <= alerts.CLOSE else on
            x = found.pop((series, first + timedelta(hours=k)))
            assert (x.n, x.on) == (v, on)
            expected.append((series, k, on))
    assert not found
    runs = sum(on and not (k and expected[i - 1][2] and expected[i - 1][0] == s) for i, (s, k, on) in enumerate(expected))
    assert alerts.alerts(levels, "series").count() == runs > 1
