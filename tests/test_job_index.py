"""Routing by an index of predicates against every job on every message."""

import datetime
import random
from collections import Counter

from postroom.operators import job_index as JI
from postroom.operators import routing as R

SCHEMA = "message_id int, sender string, recipient string, subject string, label_ids array<string>, internal_ts timestamp_ntz, has_attachment boolean, _x int"


def test_dyadic_intervals():
    rng = random.Random(1)
    for _ in range(300):
        low, high = sorted(rng.randrange(200) for _ in range(2))
        held = [x for level, node in JI.dyadic(low, high) for x in range(node << level, node + 1 << level)]
        assert sorted(held) == list(range(low, high))


def test_same_as_every_job_on_every_message(spark):
    rng = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    base = 1704067200
    words = ["", "a", "ab", "Abc", "user1@", "user11@x.example", "REPORT", "straße", "日報", "abcabcabc", None]

    def time():
        return rng.choice([None, start + datetime.timedelta(seconds=rng.randrange(2000), microseconds=rng.choice([0, 1, 999_999])), datetime.datetime(1960, 5, 5), datetime.datetime(9999, 1, 1)])

    rows = [
        (i, rng.choice(words), rng.choice(words), " ".join(w or "" for w in rng.sample(words, 3)) if i % 9 else None,
         rng.choice([None, [], ["x"], ["x", "y", "x"], [None, ""]]), time(), rng.choice([None, True, False]), i)
        for i in range(300)
    ]
    jobs = []
    for i in range(60):
        job = {"job": f"j{i % 55}"}
        for key, given in (("from", words), ("to", words), ("subject", ["*", "*report*", "straße", "日", "bc", None])):
            if rng.random() < 0.3:
                job[key] = rng.choice(given)
        if rng.random() < 0.4:
            job["label"] = rng.choice(["x", "y", "z", ""])
        if rng.random() < 0.5:
            job["after"] = rng.choice([None, base + rng.randrange(2000), -(10**9), 10**12])
        if rng.random() < 0.5:
            job["before"] = rng.choice([None, base + rng.randrange(2000), 10**12, 0])
        if rng.random() < 0.2:
            job["attachment"] = rng.choice(["true", "no", True])
        jobs.append(job)
    messages = spark.createDataFrame(rows, SCHEMA)

    def pairs(df):
        assert set(df.columns) == set(messages.columns) | {"job"}
        return Counter((r["message_id"], r["job"]) for r in df.collect())

    want = Counter()
    for i in range(0, len(jobs), 30):
        want += pairs(R.route_messages(messages, jobs[i : i + 30]))
    assert len(want) > 500
    got = JI.route_many(messages, jobs)
    assert pairs(got) == want
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()
    assert JI.route_many(messages, []).count() == JI.route_many(messages.limit(0), jobs).count() == 0
