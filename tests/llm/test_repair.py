"""Conversation repair against exhaustive search, and fill-in-middle round trips."""

import hashlib
import random
import re
import zlib

import pytest

from scorebook.llm import fill_middle, role_repair
from tests.llm.conftest import LONG, SF, needs_data

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, duplicate string, cost long"


def damage(rows):
    """rows: (conv_id, turn, role, text) -> the rows after damage."""
    out = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(c, t, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def marked(rows):
    """One conversation's rows in order -> (role, text, fault)."""
    seen, out = set(), []
    for _, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        shown = text.strip(SPACE)
        out.append((role, text, "blank" if not shown else "duplicate" if (role, text) in seen
                    else "truncated" if shown[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, repaired lines) by a search through every way to read the rest from every state
    of the role pattern; whole audits are compared."""
    memo = {}

    def follow(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def go(k, state, room):
        if (k, state, room) not in memo:
            memo[k, state, room] = None
            found = []
            if k == len(turns) and state in ("", "a"):
                found.append((0, "", ()))
            if room:
                for i, name in (("u", "user"), ("a", "assistant")):
                    if follow(state, i):
                        rest = go(k, follow(state, i), room - 1)
                        if rest:
                            found.append((3 + rest[0], "I" + rest[1], (name + ":", *rest[2])))
            if k < len(turns):
                role, text, fault = turns[k]
                choices = [(4, "D", state, ())]
                if fault not in ("blank", "duplicate"):
                    more = 3 if fault == "truncated" else 0
                    choices += [(more, "K", follow(state, role[:1]), (f"{role}:{text}",))]
                    choices += [(3 + more, "R", follow(state, n[0]), (f"{n}:{text}",)) for n in ("user", "assistant")]
                for cost, edit, after, line in choices:
                    rest = go(k + 1, after, 3) if after is not None else None
                    if rest:
                        found.append((cost + rest[0], edit + rest[1], line + rest[2]))
            memo[k, state, room] = min(found, key=lambda x: x[:2]) if found else None
        return memo[k, state, room]

    return go(0, "", 3)


def brute(rows):
    kept = damage(rows)
    out = []
    for c in {r[0] for r in rows}:
        mine = [r for r in kept if r[0] == c]
        turns = marked(mine)
        cost, audit, lines = cheapest(turns)
        n = [t for _, t, _, _ in mine if t is not None]
        faults = [f for _, _, f in turns]
        out.append((c, max(n) - min(n) + 1 - len(set(n)) if n else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def digests(df):
    return sorted((tuple(r) for r in role_repair.digest(df).collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)


ODD = [(None, 1, "user", "Hello."), (None, 2, "assistant", "Hi there."), (1, None, None, None), (1, None, "user", "Yes?"),
       (2, 0, "", "No initial."), (2, 1, "tool", "A tool."), (3, 5, "system", "Only a system turn."), (4, 0, "user", "   \n"),
       (5, 3, "user", "Same."), (5, 3, "user", "Same."), (5, 9, "assistant", "é!\t "), (6, 0, "user", LONG),
       (6, 1, "assistant", LONG + "."), (7, 1, "Assistant", "Capital."), (7, 1, "user", "Tie."), (7, 1, "assistant", "Tie.")]


def test_repair_odd_rows(spark):
    assert digests(made(spark, ODD)) == brute(ODD)


def test_repair_empty_table(spark):
    assert digests(made(spark, [])) == []


def some_turns(rng, conv, n):
    return [(conv, rng.choice([None, *range(n + 2)]) if rng.random() < 0.3 else k,
             rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None]),
             rng.choice(["One.", "Two!", "Three?", "cut", "more cut", "  ", "", None, f"Text {rng.random()}."])) for k in range(n)]


def test_repair_random(spark):
    rng = random.Random(11)
    rows = [r for conv in range(400) for r in some_turns(rng, conv, rng.randint(1, 9))]
    assert digests(made(spark, rows)) == brute(rows)


def test_repair_all_dropped_and_long(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rng = random.Random(5)
    rows = [(gone, 0, "user", "Hello."), *some_turns(rng, 100_000, 150)]
    assert digests(made(spark, rows)) == brute(rows)
    assert next(r for r in digests(made(spark, rows)) if r[0] == gone)[1:] == (
        0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_heads_stay_few_and_time_linear():
    rng = random.Random(2)
    repair = role_repair.Repair()
    for k in range(20_000):
        repair.turn(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "cut", " "]), False)
        assert len(repair.heads) <= 4
    assert len(repair.result()[6]) >= 20_000


def test_equal_tops_take_equal_continuations():
    """What merging rests on: every stack with the same top accepts the same role strings."""
    start = role_repair.Node("start")
    stacks, todo = {start}, [start]
    while todo:
        node = todo.pop()
        for s in "sua":
            after = node.shift(s)
            if after is not None and after not in stacks:
                stacks.add(after)
                todo.append(after)

    def accepts(node, word):
        for s in word:
            node = node.shift(s) if node is not None else None
        return node is not None and node.state in role_repair.ACCEPTED

    words = [""]
    for _ in range(6):
        words += [w + s for w in words for s in "sua" if len(w + s) <= 6]
    words = set(words)
    assert len(stacks) == 5
    for x in stacks:
        for y in stacks:
            if x.state == y.state:
                assert all(accepts(x, w) == accepts(y, w) for w in words)
    assert {w for w in words if accepts(start, w)} == {w for w in words if re.fullmatch("(s?(ua)+)?", w)}


def test_repaired_turns_match_hash(spark):
    rng = random.Random(4)
    rows = ODD + [r for conv in range(20, 140) for r in some_turns(rng, conv, rng.randint(1, 8))]
    hurt = role_repair.damaged(made(spark, rows)).cache()
    found = role_repair.repairs(hurt).cache()
    lines = {}
    for r in sorted(role_repair.repaired(hurt, found).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in found.collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        assert len(lines.get(r.conv_id, [])) == len(r.audit.replace("D", ""))


@needs_data
def test_repair_whole_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert digests(df) == brute(rows)


def middle_brute(rows):
    out = []
    for d, t in rows:
        t = t or ""
        h = hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()
        h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
        units = t.split("\n")
        units = [u + "\n" for u in units[:-1]] + ([units[-1]] if units[-1] else [])
        n = len(units)
        x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
        form = "plain" if not t or any(k in t for k in ("<P>", "<S>", "<M>")) else "spm" if h[3] % 100 < 50 else "psm"
        made = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        sha = lambda z: hashlib.sha256(z.encode()).hexdigest()
        out.append((d, n, form, None if form == "plain" else len(p), None if form == "plain" else len(m), sha(made), sha(t)))
    return sorted(out, key=str)


def middles(df):
    return sorted((tuple(r) for r in fill_middle.digest(df).collect()), key=str)


def test_middle_odd_rows(odd_docs):
    assert middles(odd_docs) == middle_brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_middle_empty_table(no_docs):
    assert middles(no_docs) == []


def test_middle_random_texts(spark):
    rng = random.Random(8)
    parts = ["\n", "\r\n", "a", "é", "\U0001F600", "<", "<S", "P>", "S>", "<M>", "<P>", " ", "line", " "]
    rows = [(k, "".join(rng.choices(parts[:9] + parts[11:] if k % 4 else parts, k=rng.randint(0, 30)))) for k in range(600)]
    assert middles(spark.createDataFrame(rows, "doc_id long, text string")) == middle_brute(rows)


def test_middle_rate_and_forms(spark):
    rows = [(k, "one\ntwo\nthree") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    half = fill_middle.fill_in_middle(df, rate=50, spm=100).groupBy("form").count().collect()
    counts = {r.form: r["count"] for r in half}
    assert set(counts) == {"plain", "spm"} and 850 < counts["spm"] < 1150


@pytest.mark.parametrize("unit", ["x\n", "x", "\n", "long line of text\n"])
def test_middle_long_text_is_linear(unit):
    text = unit * 300_000
    n, form, prefix, middle, out = fill_middle.transformed(text, 5, 2**31, 0, 0)
    assert n == (1 if unit == "x" else 300_000) and form == "spm" and len(out) == len(text) + 9
