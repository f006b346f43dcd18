"""Chat formatting against a loop."""

import json
import random

import pytest

from textmill.llm import tool_calls as t

SCHEMA = "conv_id long, turn long, kind string, role string, text string, call_id string, name string, arguments string"


def call(turn, call_id, name="compute", arguments='{"query":"q","limit":1}', conv=1):
    return (conv, turn, "call", "assistant", None, call_id, name, arguments)


def result(turn, call_id, text="r", conv=1):
    return (conv, turn, "result", "tool", text, call_id, None, None)


def plain(turn, text="hello", conv=1):
    return (conv, turn, "message", "user", text, None, None, None)


@pytest.fixture
def run(spark):
    def go(rows):
        return t.format_chat(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()

    return go


def test_links_and_order(run):
    rows = [plain(0), result(1, "a"), call(2, "a"), call(3, "b"), call(4, "a"), result(5, "x"), call(6, None), result(7, "a"), plain(8, None)]
    got = {r.turn: r for r in run(rows)}
    status = [got[k].status for k in range(9)]
    assert status == ["plain", "linked", "answered", "unanswered", "repeated", "orphan", "unidentified", "repeated", "plain"]
    assert got[1].position == 9 and sorted(r.position for r in got.values()) == list(range(1, 10))


def test_references_move_calls_behind_what_they_use(run):
    use = lambda i: json.dumps({"query": f"${i}", "limit": 1})
    rows = [call(0, "c", arguments=use("b")), call(1, "b", arguments=use("a")), call(2, "a"), result(3, "a"), result(4, "b"), result(5, "c")]
    order = [(r.kind, r.call_id) for r in sorted(run(rows), key=lambda r: r.position)]
    place = {k: i for i, k in enumerate(order)}
    for before, after in ((("result", "a"), ("call", "b")), (("result", "b"), ("call", "c")), (("call", "c"), ("result", "c"))):
        assert place[before] < place[after]


def test_circles_and_lost_references(run):
    use = lambda i: json.dumps({"query": f"${i}", "limit": 1})
    rows = [call(0, "a", arguments=use("b")), call(1, "b", arguments=use("a")), call(2, "c", arguments=use("nobody")), plain(3)]
    got = {r.call_id: r for r in run(rows)}
    assert got["a"].errors == ["circular"] and got["b"].errors == ["circular"] and got["c"].errors == ["no call nobody"]
    assert {got["a"].position, got["b"].position} == {3, 4}


@pytest.mark.parametrize(
    "name, arguments, errors",
    [
        ("compute", '{"limit":1,"query":"x"}', []),
        ("compute", '{"limit":"1"}', ["limit: not integer", "query: missing"]),
        ("compute", '{"limit":1,"query":"x","z":1,"b":2}', ["b: unknown", "z: unknown"]),
        ("lookup", '{"query":"x"}', []),
        ("lookup", "{broken", ["no JSON"]),
        ("lookup", None, ["no JSON"]),
        ("lookup", "[1]", ["no object"]),
        ("other", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
    ],
)
def test_validation(run, name, arguments, errors):
    assert run([call(0, "a", name, arguments)])[0].errors == errors


def test_json_is_canonical(run):
    text = 'quote " back \\ line \n tab \t é 漢 \x01'
    for row in (call(0, "a", "compute", '{ "query" : "é\\n", "limit": 12, "deep": {"b": [1, null], "a": true} }'), plain(1, text), result(2, "z", text)):
        got = json.loads(run([row])[0].json)
        want = {"kind": row[2], "role": row[3]}
        if row[4] is not None:
            want["content"] = row[4]
        if row[5] is not None:
            want["call_id"] = row[5]
        if row[6] is not None:
            want |= {"name": row[6], "arguments": json.loads(row[7])}
        assert got == want
        assert run([row])[0].json == json.dumps(got, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_edge_cases(spark, run, clashing):
    rows = [(None, 0, None, None, None, None, None, None), call(0, "a", conv=None), result(1, "a", conv=None)]
    rows += [plain(0, "x" * 200_000), plain(0, "x" * 200_000), (2, None, "call", "assistant", "t", "q", "lookup", '{"query":"x"}')]
    got = run(rows)
    assert len(got) == len(rows) and sorted(r.position for r in got if r.conv_id is None) == [1, 2, 3]
    assert {r.status for r in got if r.conv_id is None} == {"plain", "answered", "linked"}
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    assert t.format_chat(df).count() == len(rows)
    assert t.format_chat(spark.createDataFrame([], SCHEMA)).isEmpty()
    talk = spark.createDataFrame([(1, 0, None, None), (None, 1, "assistant", "a b")], "conv_id long, turn long, role string, text string")
    assert t.format_chat(t.from_conversations(talk)).count() == 2


def test_positions_are_topological(run):
    rng = random.Random(3)
    rows, needs = [], {}
    for k in range(40):
        used = rng.randrange(k) if k and rng.random() < 0.6 else None
        needs[f"c{k}"] = None if used is None else f"c{used}"
        arguments = json.dumps({"query": "x" if used is None else f"$c{used}", "limit": 1})
        rows += [call(rng.randrange(100), f"c{k}", arguments=arguments), result(rng.randrange(100), f"c{k}")]
    place = {(r.kind, r.call_id): r.position for r in run(rows)}
    for k, used in needs.items():
        assert place["call", k] < place["result", k]
        assert used is None or place["result", used] < place["call", k]


def test_calls_from_turns_hold_whole_texts(spark):
    texts = ["a \"quoted\" word \\ and\nline " * 4_000 + "end", 'he said "$c1-9" to me, ' * 5 + "é漢🎈", "short"]
    rows = [(1, 2 * k + 1, "assistant", text) for k, text in enumerate(texts)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in t.format_chat(t.from_conversations(talk)).collect()}
    for k, text in enumerate(texts):
        row = got[2 * k + 1]
        assert json.loads(row.json)["arguments"]["query"] == text
        assert not any("no call" in error for error in row.errors)
