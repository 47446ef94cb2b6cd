import json
import random

from tidemark.llm import chat

SCHEMAS = {"find": {"required": ["q"], "types": {"q": "string", "limit": "integer", "deep": "boolean", "in": "array", "of": "object"}}}
CALLS = "conv long, call string, turn long, name string, arguments string, needs array<string>, status string, level string"
RESULTS = "conv long, call string, turn long, content string, line string"


def linked(spark, calls, results):
    table = chat.link_calls(spark.createDataFrame([(*c, "x", "y") for c in calls], CALLS),
                            spark.createDataFrame([(*r, "z") for r in results], RESULTS), SCHEMAS)
    return {(r["conv"], r["call"]): r for r in table.collect()}


def test_links_faults_and_canonical_lines(spark):
    calls = [(1, "a", 0, "find", '{"q": "é\\n", "limit": 1.0e0, "deep": true}', None), (1, "b", 1, "find", '{"limit":"2", "who": 1}', ["a"]),
             (1, "c", 2, "find", '{"q":"x","in":[1],"of":{"b":1,"a":2},"limit":3}', []), (2, "a", 0, "other", "{}", None),
             (2, "b", 1, "find", "[1]", None), (2, "c", 2, "find", None, None), (2, "d", None, None, "broken", ["zz", "d"]),
             (None, "a", 0, "find", "{}", None), (3, None, 0, "find", "{}", None)]
    results = [(1, "a", 3, "ok"), (1, "c", 4, None), (2, "a", 5, "second"), (2, "a", 1, "first"), (9, "z", 7, "lost"), (None, "a", 0, "none")]
    got = linked(spark, calls, results)
    assert {k: (r["status"], r["faults"]) for k, r in got.items()} == {
        (1, "a"): ("linked", ["mistyped limit"]), (1, "b"): ("unanswered", ["missing q", "mistyped limit", "unknown who"]),
        (1, "c"): ("linked", []), (2, "a"): ("linked", ["unknown tool"]), (2, "b"): ("unanswered", ["not an object"]),
        (2, "c"): ("unanswered", ["not an object"]), (2, "d"): ("unanswered", ["not an object"]), (9, "z"): ("orphan", [])}
    assert json.loads(got[1, "c"]["line"])["arguments"] == {"in": [1], "limit": 3, "of": {"a": 2, "b": 1}, "q": "x"}
    assert '"of":{"a":2,"b":1}' in got[1, "c"]["line"]
    assert json.loads(got[2, "a"]["line"])["result"] == "first"
    assert got[9, "z"]["line"] == '{"call":"z","conv":9,"faults":[],"result":"lost","status":"orphan","turn":7}'


def test_topological_levels(spark):
    calls = [(1, str(i), 10 - i, "find", "{}", [str(i - 1)] if i else []) for i in range(6)]
    calls += [(2, "a", 0, "find", "{}", ["b"]), (2, "b", 1, "find", "{}", ["a"]), (2, "c", 2, "find", "{}", ["a"]), (2, "d", 3, "find", "{}", [])]
    calls += [(3, "a", 0, "find", "{}", []), (3, "b", 1, "find", "{}", ["a", "a", "none"])]
    got = {k: r["level"] for k, r in linked(spark, calls, []).items()}
    assert got == {(1, str(i)): i for i in range(6)} | {(2, "a"): None, (2, "b"): None, (2, "c"): None, (2, "d"): 0, (3, "a"): 0, (3, "b"): 1}


def test_repeated_rows_and_empty_tables(spark):
    call = (1, "a", 0, "find", '{"q":"x"}', None)
    assert len(linked(spark, [call, call], [(1, "a", 1, "r")] * 3)) == 1
    assert linked(spark, [], []) == {}


def plain_levels(needs):
    """Levels by the definition; None in and behind a circle."""
    known = {}
    while True:
        more = {c: 1 + max((known[n] for n in ns), default=-1) for c, ns in needs.items() if c not in known and all(n in known for n in ns)}
        if not more:
            return {c: known.get(c) for c in needs}
        known |= more


def test_levels_of_chains_and_layers_equal_the_definition(spark):
    draw, calls, expected = random.Random(3), [], {}
    for conv in range(12):
        names = [f"c{i}" for i in range(draw.choice([1, 5, 30, 70]))]
        needs = {}
        for i, name in enumerate(names):
            earlier = names[:i] if conv % 4 else names
            count = 0 if not earlier else draw.choice([0, 1, 1, 1, 1, 1, 2, 3])
            needs[name] = [n for n in dict.fromkeys(earlier[-draw.randint(1, 3):][:1] + draw.sample(earlier, min(len(earlier), count)))][:count]
        calls += [(conv, c, draw.randrange(50), "find", "{}", [*ns, c, "unknown"]) for c, ns in needs.items()]
        expected |= {(conv, c): level for c, level in plain_levels({c: [n for n in ns if n != c] for c, ns in needs.items()}).items()}
    chain = {f"k{i}": [f"k{i - 1}"] if i else [] for i in range(300)}
    calls += [(99, c, 0, "find", "{}", ns) for c, ns in chain.items()]
    expected |= {(99, f"k{i}"): i for i in range(300)}
    assert {k: r["level"] for k, r in linked(spark, calls, []).items()} == expected
    assert None in expected.values() and max(x or 0 for x in expected.values()) == 299
