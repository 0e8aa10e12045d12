"""Turn repair, by a plain search over all edits and a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from helpers import LONG, table
from hypothesis import given, settings, strategies as st

from walletscope.llm import queries, turn_repair

GOOD = re.compile(r"(s?(ua)+)?")


def all_edits(codes, inserts):
    """(cost, audit, roles) of every way to edit that ends well, with at most ``inserts`` turns put in."""
    options = []
    for code in codes:
        extra = 5 if code.isupper() else 0
        keep = [(extra, "K", code.lower()), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        options.append([(2, "D", "")] + ([] if code.isdigit() else keep))
    for chosen in itertools.product(*options):
        for where in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(codes) + 1), k) for k in range(inserts + 1)):
            for roles in itertools.product("ua", repeat=len(where)):
                steps = []
                for i in range(len(codes) + 1):
                    steps += [(5, "I", r) for w, r in zip(where, roles) if w == i]
                    steps += [chosen[i]] if i < len(codes) else []
                out = "".join(s[2] for s in steps)
                if GOOD.fullmatch(out):
                    yield sum(s[0] for s in steps), "".join(s[1] for s in steps), out


def by_library(codes, cuts=()):
    """Cost, audit and resulting initials, with checkpoints after the given rows."""
    edges = [0, *cuts, len(codes)]
    blocks = [codes[a:b] for a, b in zip(edges, edges[1:])]
    vectors = turn_repair.checkpoints([turn_repair.table(b) for b in blocks])
    state, script = 0, ""
    for i, (b, v) in enumerate(zip(blocks, vectors[1:])):
        s, state = turn_repair.scripts(b, v, i == len(blocks) - 1)[state]
        script += s
    return vectors[0][0], script.translate(str.maketrans("uaUA", "IIRR")), script


def test_cheapest_and_least_edits_by_full_search():
    rng = random.Random(2)
    for _ in range(250):
        codes = "".join(rng.choice("suaoSUA012" + "ua" * 4) for _ in range(rng.randrange(1, 5)))
        assert by_library(codes)[:2] == min(all_edits(codes, 2))[:2], codes


@settings(max_examples=200, deadline=None)
@given(st.text("suaoSUAO0123", min_size=1, max_size=40), st.data())
def test_cuts_change_nothing(codes, data):
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(codes) - 1)), max_size=5))) if len(codes) > 1 else []
    assert by_library(codes, cuts) == by_library(codes)
    assert by_library(codes)[:2] == plain_search(codes)[:2]


def plain_search(codes):
    """(cost, audit, roles) by a search without checkpoints that compares whole audits."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, state, put_in):
        ways = [(0, "", "")] if i == len(codes) and state in ("", "a") else []

        def go(cost, letter, role, step, put):
            if role is None or (state, role) in after:
                rest = best(i + step, after[state, role] if role else state, put)
                if rest:
                    ways.append((cost + rest[0], letter + rest[1], (role or "-") + rest[2]))

        if put_in < 2:
            go(5, "I", "u", 0, put_in + 1)
            go(5, "I", "a", 0, put_in + 1)
        if i < len(codes):
            extra = 5 if codes[i].isupper() else 0
            go(2, "D", None, 1, 0)
            if not codes[i].isdigit():
                go(extra, "K", codes[i].lower(), 1, 0)
                go(1 + extra, "R", "u", 1, 0)
                go(1 + extra, "R", "a", 1, 0)
        return min(ways, default=None, key=lambda w: w[:2])

    for i in range(len(codes), 0, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def plain_report(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of rows (turn, role, text)."""
    def least(r):
        return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())

    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=least)
    seen, codes, faults = set(), "", dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if fault:
            faults[fault] += 1
        codes += letter if not fault else letter.upper() if fault == "truncated" else str("suao".index(letter))
    low = "".join("suao"[int(c)] if c.isdigit() else c.lower() for c in codes)
    illegal = sum(low[i:i + 2] not in ("su", "ua", "au") for i in range(len(low) - 1))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, roles = plain_search(codes)
    lines, i, full = [], 0, {"u": "user", "a": "assistant"}
    for letter, role in zip(audit, roles):
        if letter == "I":
            lines.append(full[role] + ":")
            continue
        if letter != "D":
            lines.append((rows[i][1] if letter == "K" else full[role]) + ":" + rows[i][2])
        i += 1
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


TURNS = "conv_id long, turn long, role string, text string, extra string, key string"


def turns(rng, n):
    return [(i, rng.choice(["user", "assistant"]), f"{rng.randrange(n)}" + rng.choice([".", ".", ".", ""])) for i in range(n)]


@pytest.fixture
def odd():
    rng = random.Random(8)
    convs = {i: [(t, r, x) for t, r, x in _safe(rng, 1 + i % 7)] for i in range(30)}
    convs[None] = [(0, "user", "hello."), (0, "user", "hello."), (None, None, "x.")]
    convs[100] = turns(rng, 700)
    convs[101] = [(0, "user", LONG + "."), (1, "assistant", LONG)]
    convs[102] = [(3, "user", "tie.")] * 200
    return convs


def _safe(rng, n):
    texts = ["a.", "b!", "c?", "d. ", "e", " \t", "", None, "f.\n", "ü."]
    return [(rng.choice([None, i, i, i, 2 * i]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), rng.choice(texts))
            for i in range(n)]


def test_report_and_repair_of_odd_rows(spark, odd):
    rows = spark.createDataFrame([(c, *r, "x", "y") for c, rs in odd.items() for r in rs], TURNS)
    repair = turn_repair.Repair(rows)
    hashes = {r.key: r.sha256 for r in turn_repair.digests(turn_repair.repaired(repair)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (*tuple(r)[1:], hashes.get("" if r.conv_id is None else f"={r.conv_id}", empty)) for r in turn_repair.report(repair).collect()}
    assert got == {c: plain_report(rs) for c, rs in odd.items()}
    assert turn_repair._blocks(repair.faults).where("key = '=100'").count() == 4  # 64, 192, 320, 124 rows


def test_nothing_to_repair(spark):
    repair = turn_repair.Repair(spark.createDataFrame([], TURNS))
    assert turn_repair.report(repair).count() == 0 and turn_repair.digests(turn_repair.repaired(repair)).count() == 0


def plain_damage(rows):
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, role if role is not None else " ", text if text is not None else " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return kept


def test_query(spark, tmp_path):
    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, None, None, None), (None, 3, "user", "so.")] + [(9000 + i, 0, "user", "hi.") for i in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_turn_repair(spark, str(tmp_path)).collect()}
    expected = plain_damage(rows)
    assert any(not rs for rs in expected.values())
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: plain_report(rs) if rs else nothing for c, rs in expected.items()}
