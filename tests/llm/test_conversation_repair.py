"""Divide and conquer against all edit scripts, SQL, and conversations that span partitions."""

import itertools
import random
import re

import pytest

from cartrail.llm import conversation_repair as repair
from cartrail.llm import oracle, queries
from tests.llm import messy

KINDS = "conv_id long, turn long, role string, text string, cost string, part string, key string"


def all_scripts(codes):
    """(cost, audit) of the best among all edit scripts, tried one by one."""
    initials = "sua?"
    best = None
    row_ways = []
    for code in codes:
        ways = [("D", "", 3)]
        if code != repair.GOES:
            initial, truncated = divmod(code, 2)
            ways += [("K", initials[initial], truncated), ("R", "u", 2 + truncated), ("R", "a", 2 + truncated)]
        row_ways.append(ways)
    gaps = ["", "u", "a", "ua", "au"]
    for ways in itertools.product(*row_ways):
        for filled in itertools.product(gaps, repeat=len(codes) + 1):
            roles = filled[0] + "".join(w[1] + g for w, g in zip(ways, filled[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(filled[0]) + "".join(w[0] + "I" * len(g) for w, g in zip(ways, filled[1:], strict=True))
                option = sum(w[2] for w in ways) + 2 * sum(map(len, filled)), audit
                best = min(best or option, option)
    return best


def by_strings(codes):
    """(cost, audit) by carrying whole audits along."""
    held = {repair.START: (0, "")}
    for code in codes:
        found = {}
        for state, (cost, audit) in held.items():
            for after, more, letters in repair.EDITS[code][state]:
                option = cost + more, audit + letters
                found[after] = min(found.get(after, option), option)
        held = found
    return min((cost + repair.TAIL[s][0], audit + repair.TAIL[s][1]) for s, (cost, audit) in held.items())


def divided(codes):
    cost, letters, tail = repair.whole_repair(bytes(codes))
    return cost, "".join(letters) + tail


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_against_all_scripts(length):
    every = list(itertools.product(range(9), repeat=length))
    for codes in every if length < 3 else random.Random(1).sample(every, 60):
        assert divided(codes) == all_scripts(codes)


def test_against_whole_audits():
    pick = random.Random(3)
    for _ in range(600):
        codes = [pick.randrange(9) for _ in range(pick.randint(0, 40))]
        assert divided(codes) == by_strings(codes)
    codes = [pick.choice([2, 4, 2, 4, 0, 6, 8, 3]) for _ in range(5000)]
    assert divided(codes) == by_strings(codes)


def rows(seed=5):
    pick = random.Random(seed)
    texts = ["Hello there.", "What?", "no end", "", " \t\n", "same.", "Ünï 漢字!", "a.b", "x" * 3000 + ".", None]
    roles = ["user", "assistant", "system", "user", "assistant", "admin", "USER", "", None]
    found = [(9, t, "user", "same.") for t in range(30)]  # all but one repeated
    for conv in [*range(40), None]:
        for turn in range(pick.randint(1, 9)):
            found.append((conv, pick.choice([turn, turn, turn + 5, None]), pick.choice(roles), pick.choice(texts)))
    found += [(777, t % 400 if t % 7 else None, roles[t % 5], f"turn {t % 350}.") for t in range(1500)]  # a hot one
    found += [(888, 5, "user", "just the same.")] * 200
    return [(*r, "clash", "clash", "clash") for r in found]


def compare(spark, tmp_path, held):
    table = spark.createDataFrame(held, KINDS).repartition(5)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    columns, expected = messy.oracle_rows(oracle.OP12, conversations=table)
    messy.same_rows(queries.op12_repair_conversations(spark, str(tmp_path)), columns, expected)
    return expected


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_messy_conversations(spark, tmp_path, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled="false")
    expected = compare(spark, tmp_path, rows())
    assert len(expected) == 43 and any(len(r[7]) > 1000 for r in expected)


def test_empty_conversations(spark, tmp_path):
    assert compare(spark, tmp_path, []) == []


def test_a_hot_conversation_is_shared_out(spark, conf):
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__enabled="false")
    held = spark.createDataFrame(rows(), KINDS).repartition(6)
    prepared = repair.prepared(held, "conv_id", "turn", "role", "text")
    table = repair.in_partitions(prepared, turns=False).where("what = 'row'")
    parts = {(r["key"], r["part"]) for r in table.select("key", "part").distinct().collect()}
    assert sum(key == "+777" for key, _ in parts) > 3
    by_part = [part for _, part in parts]
    assert max(by_part.count(p) for p in by_part) <= 2


def test_repaired_turns_have_the_structure(spark, conf):
    conf(spark__sql__shuffle__partitions="7", spark__sql__adaptive__enabled="false")
    held = spark.createDataFrame(rows(), KINDS)
    turns = repair.repaired_turns(held).collect()
    audits = {r["conv_id"]: r["audit"] for r in repair.repair(held).collect()}
    for conv, audit in audits.items():
        mine = sorted((r for r in turns if r["conv_id"] == conv), key=lambda r: (r["part"], r["seq"]))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in mine))
        assert "".join(r["edit"] for r in mine) == audit.replace("D", "")
