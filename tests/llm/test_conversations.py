import hashlib
import itertools
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from aljibe.llm import conversations
from aljibe.llm.conversations import BLANK, DUPLICATE, SOUND, TRUNCATED, Repair

GRAMMAR = re.compile(r"(?:s?(?:ua)+)?\Z")


def brute(rows):
    """The cheapest edits of all there are: every row kept, reroled or deleted, up to two inserts in every gap."""
    best = None
    per_row = [["D"] if fault in (BLANK, DUPLICATE) else ["D", "K", "Ru", "Ra"] for _, _, fault in rows]
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for edits in itertools.product(*per_row):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for place in range(len(rows) + 1):
                for role in gaps[place]:
                    cost, audit = cost + 2, audit + "I"
                    out.append(({"u": "user", "a": "assistant"}[role], ""))
                if place < len(rows):
                    role, text, fault = rows[place]
                    edit = edits[place]
                    audit += edit[0]
                    cost += {"D": 3, "K": 0, "R": 2}[edit[0]] + (fault == TRUNCATED and edit != "D")
                    if edit != "D":
                        out.append(({"K": role, "Ru": "user", "Ra": "assistant"}[edit], text))
            if GRAMMAR.match("".join(role[:1] or "?" for role, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return best


def of(rows):
    repair = Repair()
    for row in rows:
        repair.add(*row)
    return repair.end()


ROWS = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b"]), st.sampled_from([SOUND, SOUND, TRUNCATED, BLANK, DUPLICATE]))


@settings(max_examples=40, deadline=None)
@given(st.lists(ROWS, max_size=3))
def test_edits_equal_brute_force(rows):
    assert of(rows) == brute(rows)


def plain(rows):
    """Viterbi with whole strings, for conversations too long for brute force."""
    alive = {0: (0, "", ())}
    def inserted(alive):
        for state, sources in ((2, (0, 1, 3)), (3, (2,))):
            for s in sources:
                if s in alive:
                    new = (alive[s][0] + 2, alive[s][1] + "I", (*alive[s][2], ("user" if state == 2 else "assistant", "")))
                    alive[state] = min(alive.get(state, new), new, key=lambda x: x[:2])
        return alive

    alive = inserted(alive)
    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, out) in alive.items():
            steps = [(state, cost + 3, "D", out)]
            if fault not in (BLANK, DUPLICATE):
                extra = fault == TRUNCATED
                for letter, price, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    after = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((name[:1], state))
                    if after is not None:
                        steps.append((after, cost + price + extra, letter, (*out, (name, text))))
            for after, price, letter, out_ in steps:
                one = (price, audit + letter, out_)
                new[after] = min(new.get(after, one), one, key=lambda x: x[:2])
        alive = inserted(new)
    cost, audit, out = min((alive[s] for s in (0, 3) if s in alive), key=lambda x: x[:2])
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(ROWS, max_size=60))
def test_long_edits_equal_whole_strings(rows):
    assert of(rows) == plain(rows)


def nodes(repair):
    found, left = 0, [repair.root]
    while left:
        found, left = found + 1, left[:-1] + left[-1].children
    return found


def test_certain_edits_are_emitted_and_forgotten():
    repair, most = Repair(), 0
    for i in range(4000):
        repair.add("user" if i % 2 == 0 or i % 97 == 0 else "assistant", f"t{i}.", SOUND if i % 31 else TRUNCATED)
        most = max(most, nodes(repair))
    assert most < 120 and len(repair.letters) > 3900


def test_a_tie_costs_the_same_however_long_the_tied_suffixes_are():
    """User rows only: two parities are never resolved. The tree holds a few nodes per row, and 40,000 rows take no time."""
    repair = Repair()
    for i in range(40_000):
        repair.add("user", "x.", SOUND)
    assert nodes(repair) < 40_000 * 4
    assert of([("user", "x.", SOUND)] * 51) == plain([("user", "x.", SOUND)] * 51)
    assert repair.end()[0] == 40_000


def expected(rows):
    """Rows of ``repaired`` after the damage, by plain Python."""
    found = {}
    for conv, turn, role, text in rows:
        mine = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, mine in found.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append(BLANK if not last else DUPLICATE if (role, text) in seen else SOUND if last[0] in ".!?" else TRUNCATED)
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        out.append((conv, gaps, *counts, illegal, *plain([(r, t, f) for (_, r, t), f in zip(mine, faults)])))
    return out


def conversations_of(seed):
    import random

    dice, rows = random.Random(seed), []
    for conv in [None, *range(60)]:
        for turn in range(dice.randrange(1, 30)):
            role = dice.choice(["user", "assistant", "user", "assistant", "system", None, "", "Tool"])
            text = dice.choice(["yes.", "no", "why?\n", " \t", "", None, "wait! ", f"turn {turn}.", "x\x1c"])
            rows.append((conv, dice.choice([turn, turn, turn * 3, None]), role, text))
    return rows


def test_rows_equal_plain_python(spark, rows, with_clashes):
    given_rows = conversations_of(1)
    frame = with_clashes(spark.createDataFrame(given_rows, "conv_id long, turn long, role string, text string"))
    from pyspark.sql import functions as F

    frame = frame.withColumn("fault", F.lit("x")).withColumn("gone", F.lit("y")).repartition(5)
    assert rows(conversations.repaired(conversations.damaged(frame), gone_col="gone")) == sorted(expected(given_rows), key=repr)
    assert conversations.repaired(conversations.damaged(frame.limit(0)), gone_col="gone").collect() == []


def test_a_conversation_all_of_whose_rows_are_gone(spark):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(conv, 0, "user", "hello.")], "conv_id long, turn long, role string, text string")
    row = conversations.repaired(conversations.damaged(frame), gone_col="gone").collect()
    assert [tuple(r) for r in row] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_one_shuffle_and_extreme_turns(spark):
    frame = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    found = conversations.repaired(frame)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert found.first()["gaps"] == 2**63 - 1 and found.first()["audit"] == "KK"
