"""What the plans send to every task whole: nothing whose size is read off files alone, unless its rows were counted."""

import random

import pytest
from helpers import documents
from test_minhash import brute_force

import corpus_pipeline
from tidemark.llm import components, line_templates, minhash
from tidemark.plans import staging

WORDS = [f"w{i}" for i in range(300)]


def rows_of_copies():
    """Near copies, and texts that share a passage and no more."""
    draw = random.Random(3)
    base, passage = draw.choices(WORDS, k=60), draw.choices(WORDS, k=40)
    rows = [(i, " ".join([*base[:i % 50], f"edit{i}", *base[i % 50 + 1:]])) for i in range(60)]
    return [*rows, *((i, " ".join(draw.choices(WORDS, k=draw.randrange(5, 40)) + passage)) for i in range(60, 160))]


def names(plan, below=""):
    """Class names of a plan's nodes, each behind those above it."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return names(plan.initialPlan(), below)
    found, children = [f"{below}/{kind}"], plan.children()
    for at in range(children.size()):
        found += names(children.apply(at), found[0])
    return found


def unmeasured(df):
    """Broadcasts of the plan, as it stands before anything ran, that read files without a shuffle between."""
    found = names(df._jdf.queryExecution().executedPlan())
    sent = [name for name in found if name.endswith("/BroadcastExchangeExec")]
    below = {name: {x.rpartition("/")[2] for x in found if x.startswith(f"{name}/")} for name in sent}
    return [name for name in sent if "FileSourceScanExec" in below[name] and "ShuffleExchangeExec" not in below[name]]


@pytest.fixture
def checked(monkeypatch):
    """A function after which the modules it is given take every counted table for a long one, and store no unmeasured broadcast."""

    def stored(df, label="stage"):
        assert unmeasured(df) == [], label
        return staging.stored(df, label)

    def use(*modules):
        for module in modules:
            monkeypatch.setattr(module, "stored", stored)
            monkeypatch.setattr(module, "broadcast_if_small", lambda df, rows=0: df, raising=False)

    return use


def test_near_duplicates_sends_nothing_unmeasured(spark, checked):
    rows = rows_of_copies()
    docs = staging.stored(documents(spark, rows))
    checked(minhash, components)
    found = minhash.near_duplicates(docs)
    assert unmeasured(found) == []
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)


def test_recurring_lines_send_nothing_unmeasured(spark, checked):
    kinds = ("red", "green", "blue", "grey", "pink", "white")
    rows = [(i, f"own line {kind} of this one text alone {kind}\nRead all about it here in {kind} today") for i, kind in enumerate(kinds)]
    docs = staging.stored(documents(spark, rows, extra=False))
    checked(line_templates)
    found = line_templates.drop_recurring(docs)
    assert unmeasured(found) == []
    assert sorted((r["doc_id"], r["text"]) for r in found.collect()) == [(i, text.split("\n")[0]) for i, text in rows]


def test_pipeline_stages_send_nothing_unmeasured(spark, checked, monkeypatch):
    rows = [(1, "one two"), (2, "one two three"), (2, "one two three"), (3, "four"), (None, "four")]
    docs = staging.stored(documents(spark, rows, extra=False))

    def paired(docs, key):
        return docs.selectExpr(f"{key} AS id", "xxhash64(substring(text, 1, 3)) AS component_id")

    monkeypatch.setattr(minhash, "near_duplicates", paired)
    checked(corpus_pipeline)
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "")
    assert unmeasured(kept) == []
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "one two"), (3, "four")]
    encoded = corpus_pipeline.encode_tokens(spark, docs, "")
    assert unmeasured(encoded.select("doc_id", "ids")) == []
    assert encoded.count() == len(rows)
