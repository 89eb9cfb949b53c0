import random
from collections import Counter

import duckdb

from lodestone.llm import preference

SCHEMA = "conv_id long, turn long, role string, text string"


def rows():
    rng = random.Random(5)
    out = []
    for pair in range(60):
        shared = [(t, rng.choice(["user", "assistant", "system", None]), rng.choice(["hi", "ünï", None, "", "x" * 30])) for t in range(rng.randint(0, 5))]
        for side in (0, 1):
            if rng.random() < 0.1:
                continue
            tail = [(len(shared) + t, rng.choice(["user", "assistant"]), rng.choice(["a", "b"])) for t in range(rng.randint(0, 4))]
            out += [(2 * pair + side, *t) for t in shared + tail]
    out += [(1000, 0, "user", "hot"), (1001, 0, "user", "hot"), (1000, 1, "assistant", "one"), (1000, 1, "assistant", "two"), (1001, 1, "assistant", "two"), (1001, 1, "assistant", "one"), (1001, 2, "assistant", "more")]
    out += [(1000 + i % 2, 5 + i, "user", "same") for i in range(0, 40)]
    out += [(None, 0, "user", "lost"), (2000, None, "assistant", "no number"), (2001, None, "assistant", "no number")]
    return out


def brute(data):
    pairs = {}
    for c, t, role, text in data:
        if c is not None:
            pairs.setdefault(c // 2, {"chosen": [], "rejected": []})["rejected" if c % 2 else "chosen"].append((float("-inf") if t is None else t, t, role, text))
    out = Counter()
    for pair, sides in pairs.items():
        by = {s: {} for s in sides}
        for s, turns in sides.items():
            for k, *rest in turns:
                by[s].setdefault(k, []).append(tuple(rest))
        fork = next((k for k in sorted({*by["chosen"], *by["rejected"]}) if Counter(by["chosen"].get(k, [])) != Counter(by["rejected"].get(k, []))), None)
        for s, turns in sides.items():
            for k, t, role, text in turns:
                shared = fork is None or k < fork
                if shared and s == "rejected":
                    continue
                head = f"<|{role or 'unknown'}|>\n"
                rendered = head + (text or "") + "<|end|>\n"
                trained = not shared and role == "assistant"
                out[pair, "prompt" if shared else s, t, role, rendered, trained, len(head) if trained else None, len(rendered) - 1 if trained else None] += 1
    return out


def put_together(turns, part_turns):
    """Rows of ``brute`` as pairs, without the operator's code."""
    first, begins = {}, {}
    for (pair, segment, t, *_), _ in turns.items():
        if t is not None:
            first[pair] = min(t, first.get(pair, t))
            begins[pair, segment] = min(t, begins.get((pair, segment), t))
    forks = {p: min(begins[q, s] for q, s in begins if q == p and s != "prompt") for p, s in begins if s != "prompt"}
    untimed = {p for p, s, t, *_ in turns if t is None and s != "prompt"}
    rows = {}
    for (pair, segment, t, role, rendered, trained, a, b), n in turns.items():
        base = first.get(pair) if segment == "prompt" or pair in untimed else forks[pair]
        part = 0 if t is None else (t - base) // part_turns
        rows.setdefault((pair, part), {}).setdefault(segment, []).extend([((t is not None, t or 0), (role is not None, role or ""), rendered, trained, a, b)] * n)
    out = set()
    for (pair, part), segments in rows.items():
        text, mask = {}, {"chosen": [], "rejected": []}
        for segment, turns_ in segments.items():
            at = ""
            for _, _, rendered, trained, a, b in sorted(turns_, key=lambda x: x[:3]):
                if trained:
                    mask[segment].append(f"{len(at) + a}-{len(at) + b}")
                at += rendered
            text[segment] = at
        out.add((pair, part, text.get("prompt", ""), text.get("chosen", ""), text.get("rejected", ""), ",".join(mask["chosen"]), ",".join(mask["rejected"])))
    return out


def test_matches_brute_force_and_sql(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in data], SCHEMA + ", fork int, segment string, part int")
    turns = brute(data)
    got = Counter((r.pair_id, r.segment, r.turn, r.role, r.rendered, r.trained, r.mask_start, r.mask_end) for r in preference.format_pairs(preference.neighbours(df)).collect())
    assert got == turns
    for part_turns in (3, preference.PART_TURNS):
        pairs = preference.spell_masks(preference.assemble(preference.format_pairs(preference.neighbours(df), part_turns=part_turns)))
        made = [tuple(r) for r in pairs.collect()]
        assert len(made) == len(set(made)) and set(made) == put_together(turns, part_turns)
    con = duckdb.connect()
    conversations = df.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    con.register("conversations", conversations)
    names = ", ".join(("pair_id", "part", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"))
    assert set(con.execute(f"SELECT {names} FROM ({preference.OP2_SQL})").fetchall()) == set(made)


def test_assembled_pairs(spark):
    data = [(0, 0, "user", "q"), (1, 0, "user", "q"), (0, 1, "assistant", "good"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"), (2, 0, "user", "alone")]
    out = {r.pair_id: r for r in preference.assemble(preference.format_pairs(preference.neighbours(spark.createDataFrame(data, SCHEMA)))).collect()}
    r = out[0]
    assert r.prompt == "<|user|>\nq<|end|>\n" and r.chosen == "<|assistant|>\ngood<|end|>\n"
    assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == ["good<|end|>"]
    assert [r.rejected[m.start : m.end] for m in r.rejected_mask] == ["bad<|end|>"]
    assert out[1].prompt == "" and out[1].rejected == "" and out[1].chosen == "<|user|>\nalone<|end|>\n"
    assert preference.format_pairs(preference.neighbours(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_pair_of_5000_turns_is_whole(spark):
    data = [(side, t, ("user", "assistant")[t % 2], f"turn {t}" if t < 3000 else f"{side} {t}") for side in (0, 1) for t in range(5000)]
    out = sorted(preference.assemble(preference.format_pairs(preference.neighbours(spark.createDataFrame(data, SCHEMA)))).collect(), key=lambda r: r.part)
    assert [r.part for r in out] == [0, 1, 2]
    whole = lambda texts: "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in texts)
    assert "".join(r.prompt for r in out) == whole([x[2:] for x in data if x[0] == 0 and x[1] < 3000])
    for side, name in ((0, "chosen"), (1, "rejected")):
        assert "".join(r[name] for r in out) == whole([x[2:] for x in data if x[0] == side and x[1] >= 3000])
        said = [r[name][m.start : m.end] for r in out for m in r[f"{name}_mask"]]
        assert said == [f"{side} {t}<|end|>" for t in range(3000, 5000) if t % 2]


def test_large_and_negative_ids_pair_exactly(spark):
    ids = [2**60, 2**60 + 1, 2**60 + 2, -4, -3, -1]
    got = {r.conv_id: (r.pair_id, r.side) for r in preference.neighbours(spark.createDataFrame([(i, 0, "user", "x") for i in ids], SCHEMA)).collect()}
    assert got == {i: (i // 2, "rejected" if i % 2 else "chosen") for i in ids}
