import hashlib
import random

from postroom.llm import chat


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int, pos int")


def brute(rows):
    by: dict = {}
    for c, t, r, x, *_ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, held in by.items():
        held.sort(key=lambda v: (v[0], v[1], v[2].encode(), v[3].encode()))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in held)
        loss = "".join(x for _, _, r, x in held if r == "assistant")
        out[c] = (len(held), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def rows_of(rng):
    signs = ["<turn ", "</turn>", "\\", "\\s", "\\l", ">\n", "\n", "\n</turn>\n", "<turn assistant>\n", "é🙂", "word "]
    rows = []
    for c in range(12):
        for t in range(rng.randint(1, 25)):
            role = rng.choice(["system", "user", "assistant", "tool>\n<turn x", "\\n", None])
            rows.append((c, t // 2 if c % 2 else t, role, rng.choice([None, "", "".join(rng.choice(signs) * rng.randint(1, 20) for _ in range(rng.randint(0, 12)))]), 1, 2))
    rows += [(50, 0, "user", "x" * 9000, 1, 2), (50, 1, "assistant", "y" * 9000, 1, 2), (None, None, "user", "no id", 1, 2), (None, 0, "assistant", "ok", 1, 2)]
    return rows + rows[:5]


def test_round_trip(spark):
    rows = rows_of(random.Random(7))
    got = {}
    for r in chat.read_back(chat.windows(table(spark, rows))).collect():
        got[r["conv_id"]] = (r["n_turns"], hashlib.sha256(r["turns"].encode()).hexdigest(), len(r["loss"]), hashlib.sha256(r["loss"].encode()).hexdigest())
    assert got == brute(rows)
    assert chat.windows(table(spark, [])).count() == 0


def test_windows_keep_their_budget(spark):
    rng = random.Random(8)
    rows = [(1, 0, "system", "be kind " * 10, 0, 0)] + [(1, t, "assistant" if t % 2 == 0 else "user", "a" * rng.randint(1, 600), 0, 0) for t in range(1, 80)]
    found = sorted(chat.windows(table(spark, rows)).collect(), key=lambda r: r["window"])
    assert len(found) > 5
    for k, r in enumerate(found):
        segments = r["segments"]
        new = [s for s in segments if not s["repeated"]]
        tokens = sum(-(-(s["length"] + len(s["role"]) + 17) // 4) for s in new)
        assert tokens <= chat.BUDGET
        again = [s for s in segments if s["repeated"] and s["role"] != "system"]
        assert len(again) <= chat.HISTORY_TURNS and sum(-(-(s["length"] + len(s["role"]) + 17) // 4) for s in again) <= chat.HISTORY_TOKENS
        assert [s["role"] for s in segments].count("system") == 1
        assert not any(s["loss"] for s in segments if s["repeated"] or s["role"] != "assistant")
        for s in segments:
            assert r["text"][s["start"] : s["start"] + s["length"]].strip("a") in ("", "be kind " * 10)
    assert sum(s["loss"] for r in found for s in r["segments"]) == sum(r[2] == "assistant" for r in rows)


def test_hot_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t}", 0, 0) for t in range(3000)] + [(c, 0, "assistant", "ok", 0, 0) for c in range(2, 50)]
    got = {r["conv_id"]: r for r in chat.read_back(chat.windows(table(spark, rows))).collect()}
    assert got[1]["n_turns"] == 3000 and got[1]["loss"] == "".join(f"turn {t}" for t in range(1, 3000, 2))
