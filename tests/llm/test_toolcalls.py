import json

from tablexport.llm import toolcalls

CALL = "conv_id long, turn long, call_id string, name string, arguments string, parent_id string, json string"
RESULT = "call_id string, turn long, content string, depth string"
SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", False), "tags": ("array", False)}, "say": {"text": ("string", True), "loud": ("boolean", False)}}


def linked(spark, calls, results=()):
    out = toolcalls.link(spark.createDataFrame([(*c, "x") for c in calls], CALL), spark.createDataFrame([(*r, "x") for r in results], RESULT), SCHEMAS)
    return out.collect()


def test_linking_order_and_repeats(spark):
    calls = [(1, 9, "c", "add", '{"a":1}', "b"), (1, 5, "b", "add", '{"a":2}', "a"), (1, 7, "a", "add", '{"a":3}', None), (1, 8, "a", "add", '{"a":4}', None),
             (1, 1, "d", "add", '{"a":5}', "missing"), (None, 1, "e", None, None, "a"), (2, 1, None, "say", '{"text":"x"}', None)]
    out = linked(spark, calls, [("a", 8, "later"), ("a", 7, "r"), ("z", 3, "stray"), (None, 4, "lost"), ("b", 6, None)])
    by_id = {r["call_id"]: r for r in out if r["call_id"]}
    assert {k: (r["depth"], r["n_calls"], r["n_results"], r["linked"]) for k, r in by_id.items()} == {
        "a": (0, 2, 2, "linked"), "b": (1, 1, 1, "linked"), "c": (2, 1, 0, "no_result"), "d": (0, 1, 0, "no_result"), "e": (1, 1, 0, "no_result"), "z": (None, 0, 1, "orphan_result")}
    assert sorted(r["linked"] for r in out if r["call_id"] is None) == ["no_id", "no_id"]
    order = [r["call_id"] for r in out if r["conv_id"] == 1]
    assert order == ["d", "a", "b", "c"]
    assert json.loads(by_id["a"]["json"])["result"] == "r" and json.loads(by_id["a"]["json"])["arguments"] == {"a": 3}
    for r in out:
        text = r["json"]
        assert list(json.loads(text)) == sorted(json.loads(text)) and json.dumps(json.loads(text), separators=(",", ":"), ensure_ascii=False) == text


def test_long_chains_and_cycles(spark):
    chain = [(0, i, f"n{i}", "say", '{"text":"t"}', f"n{i - 1}" if i else None) for i in range(300)]
    cycle = [(0, i, f"y{i}", "say", '{"text":"t"}', f"y{(i + 1) % 3}") for i in range(3)] + [(0, 9, "above", "say", "{}", "y0"), (0, 9, "self", "say", "{}", "self")]
    out = {r["call_id"]: r["depth"] for r in linked(spark, chain + cycle)}
    assert [out[f"n{i}"] for i in range(300)] == list(range(300))
    assert {out[k] for k in ("y0", "y1", "y2", "above", "self")} == {None}


def test_arguments_against_schemas(spark):
    cases = [("add", '{"b": 2.5, "a": 1}', "valid"), ("add", '{"a":1,"tags":["x"]}', "valid"), ("add", '{"a":"1"}', "invalid"), ("add", "{}", "invalid"),
             ("add", '{"a":1,"c":1}', "invalid"), ("add", '{"a":null}', "invalid"), ("add", '{"a":1.5}', "invalid"), ("say", '{"text":"é\\n","loud":false}', "valid"),
             ("say", '{"text":"x","loud":1}', "invalid"), ("none", "{}", "unknown_tool"), (None, "{}", "unknown_tool"), ("add", "[1]", "malformed"), ("add", "{", "malformed"),
             ("add", None, "malformed"), ("add", "", "malformed"), ("add", '{"a":1,"a":2}', "malformed")]
    out = {r["call_id"]: r for r in linked(spark, [(0, i, str(i), n, a, None) for i, (n, a, _) in enumerate(cases)])}
    assert [out[str(i)]["validity"] for i in range(len(cases))] == [v for *_, v in cases]
    assert json.loads(out["0"]["json"])["arguments"] == {"a": 1, "b": 2.5} and '{"a":1,"b":2.5}' in out["0"]["json"]


def test_empty_tables_and_conversations(spark):
    assert linked(spark, []) == []
    conv = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", None), (1, 3, "user", "x"), (None, 1, "user", "u"),
                                  (2, 0, "assistant", "first"), (3, None, "user", "v"), (4, 0, None, "w")], "conv_id long, turn long, role string, text string")
    out = toolcalls.link(*toolcalls.as_calls(conv), toolcalls.ANSWER).collect()
    got = {(r["call_id"], r["linked"], r["depth"], r["n_calls"], r["validity"]) for r in out}
    assert got == {("1:1", "linked", 0, 1, "valid"), ("1:3", "no_result", 1, 2, "valid"), ("2:-1", "orphan_result", None, 0, None),
                   (None, "no_id", 0, 1, "valid")}


def test_a_number_has_one_form(spark):
    groups = [["100", "1e2", "100.0", "1.00E+2", "1000e-1"], ["1", "1.00", "1.0e0"], ["0", "-0", "-0.0", "0e5", "0.000"], ["0.00001", "1e-5", "10E-6"], ["-2.5", "-2.50", "-25e-1"],
              ["1e300", "10e299"], ["-1.5e-200", "-15e-201"], ["12345678901234567890123456789.125"], ["100000000000000000000", "1e20"]]
    flat = [(g, t) for g, ts in enumerate(groups) for t in ts]
    out = {r["call_id"]: r for r in linked(spark, [(0, i, str(i), "add", '{"a": 1, "b": %s, "tags": [%s, {"x": %s}]}' % (t, t, t), None) for i, (_, t) in enumerate(flat)])}
    text = [out[str(i)]["json"].split(',"call_id"')[0] for i in range(len(flat))]
    for i, (g, t) in enumerate(flat):
        assert text[i] == text[[h for h, _ in flat].index(g)] and json.loads(text[i] + "}")["arguments"]["b"] == float(t)
    assert len(set(text)) == len(groups) and '"b":100,' in text[0] and '"b":0.00001,' in text[13] and '"b":12345678901234567890123456789.125,' in "".join(text)
    assert {r["validity"] for r in out.values()} == {"valid"}
    whole = {r["call_id"]: r["validity"] for r in linked(spark, [(0, i, t, "add", '{"a":%s}' % t, None) for i, t in enumerate(["1.00", "1e2", "1e300", "1.5", "15e-1", "1e-3"])])}
    assert whole == {"1.00": "valid", "1e2": "valid", "1e300": "valid", "1.5": "invalid", "15e-1": "invalid", "1e-3": "invalid"}


def test_strings_stay_as_they_are(spark):
    texts = ['1.00 "2.50" \\ 3e2', "\\", '"', '\\"1.0', "", "\x01\x02 1.0", "\n1.10\t", "é😀 -0", "7.0" * 50_000 + '\\"' * 50_000]
    out = {r["call_id"]: r["json"] for r in linked(spark, [(0, i, str(i), "say", json.dumps({"text": t, "1.0": [t]}), None) for i, t in enumerate(texts)])}
    for i, t in enumerate(texts):
        assert json.loads(out[str(i)])["arguments"] == {"1.0": [t], "text": t}


def test_arguments_that_are_no_object_keep_their_text(spark):
    texts = ["{", '{"a":1,"a":2}', "[1.0]", '"x"', "", "null", "a\\\"\n"]
    out = {r["call_id"]: r for r in linked(spark, [(0, i, str(i), "add", t, None) for i, t in enumerate([*texts, None])])}
    assert [json.loads(out[str(i)]["json"])["arguments"] for i in range(len(texts) + 1)] == [*texts, None]
    assert {r["validity"] for r in out.values()} == {"malformed"}


def test_turns_of_other_roles_have_rows(spark):
    conv = spark.createDataFrame([(1, 0, "system", 's "1.0"', 0), (1, 0, "system", 's "1.0"', 1), (1, 1, "user", "q", 0), (1, None, None, None, 0), (None, 5, "tool", "t", 0)],
                                 "conv_id long, turn long, role string, text string, json long")
    out = toolcalls.link(*toolcalls.as_calls(conv), toolcalls.ANSWER, toolcalls.other_turns(conv)).where("linked = 'not_a_call'").collect()
    got = sorted((str(r["conv_id"]), str(r["turn"]), str(r["name"]), str(json.loads(r["json"])["result"]), r["call_id"], r["depth"], r["n_calls"], r["n_results"], r["validity"]) for r in out)
    rest = (None, None, 0, 0, None)
    assert got == [("1", "0", "system", 's "1.0"', *rest)] * 2 + [("1", "None", "None", "None", *rest), ("None", "5", "tool", "t", *rest)]
    assert toolcalls.other_turns(conv.limit(0)).collect() == []
