import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import chat, url_rules

EVENTS = "conv_id long, seq long, message_id string, op string, role string, text string"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\im_start>end\na ", max_size=40), st.text(alphabet="<|\\n\nuser>", max_size=12))
def test_turns_read_back(text, role):
    rendered = chat.render_turn(role, text)
    assert chat.read_turn(rendered) == (role, text)
    assert rendered.count(chat.START) == rendered.count(chat.END) == 1


def turns(spark, rows):
    got = chat.format_chats(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "turn").collect()
    return [(r["conv_id"], r["turn"], *chat.read_turn(r["rendered"])) for r in got]


def test_deltas_edits_and_regenerations_are_folded(spark):
    rows = [
        (1, 1, "a", "create", "user", "Hi"), (1, 2, "b", "create", "assistant", ""), (1, 3, "b", "delta", None, "He"),
        (1, 4, "b", "delta", None, "llo"), (1, 5, "c", "create", "user", "more"), (1, 6, "d", "create", "assistant", "x"),
        (1, 7, "b", "regenerate", None, ""), (1, 8, "b", "delta", None, "Hey"), (1, 9, "a", "edit", None, "Hi!"),
        (1, 10, "e", "create", "user", "after"),
        (2, 2, "b", "delta", "assistant", "late"), (2, 1, "a", "create", "user", None), (2, None, "z", None, None, "end"),
        (None, 1, "a", "create", "user", "no id")]
    assert turns(spark, rows) == [
        (None, 0, "user", "no id"), (1, 0, "user", "Hi!"), (1, 1, "assistant", "Hey"), (1, 2, "user", "after"),
        (2, 0, "user", ""), (2, 1, "assistant", "late"), (2, 2, "", "end")]


def test_repeated_rows_and_empty_logs(spark):
    rows = [(1, 1, "a", "create", "user", "x"), (1, 2, "a", "delta", "user", "y"), (1, 2, "a", "delta", "user", "y")]
    assert turns(spark, rows) == [(1, 0, "user", "xyy")]
    empty = spark.createDataFrame([], EVENTS)
    assert chat.read_back(chat.format_chats(empty)).count() == 0


def test_tied_turns_are_ordered_by_role_and_text(spark):
    rows = [(1, 1, "a", "create", "user", "y"), (1, 1, "b", "create", "user", "x"), (1, 1, "c", "create", "assistant", "z"),
            (1, 1, "d", "create", "user", "x")]
    assert turns(spark, rows) == [(1, 0, "assistant", "z"), (1, 1, "user", "x"), (1, 2, "user", "x"), (1, 3, "user", "y")]


def test_read_back_digests(spark):
    rows = [(k, s, f"{k}-{s}", "create", "assistant" if s % 2 else "user", f"<|im_end|> {k} {s} é" * (s + 1))
            for k in range(20) for s in range(5)]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, EVENTS))).collect()}
    for k in range(20):
        own = [r for r in rows if r[0] == k]
        said = "".join(r[5] for r in own if r[4] == "assistant")
        assert got[k]["n_turns"] == 5
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r[4]}\n{r[5]}\n" for r in own).encode()).hexdigest()
        assert (got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[k]["formatted_chars"] == sum(len(chat.render_turn(r[4], r[5])) for r in own)


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/ok/", "allow"),
         ("a.example.org", "/", "block"), ("a.example.org", "/", "allow"), ("com", "", "block"), ("net", None, "block"),
         ("xample.org", "/", "block"), ("example.org.uk", "/", "block")]
URLS = ["http://example.org/es/1", "https://B.a.Example.ORG/es/ok/2?x#y", "http://example.org", "http://example.org/es",
        "http://org/x", "http://myorg/x", "http://x.com?q=/a", "ftp://com", "nothing", "", None, "http:///path",
        "http://b.example.net/x", "http://example.org/es/ok/", "a://b.example.org://c", "http://xample.org/é",
        "http://a.example.org.uk/", "http://example.org/es/ok/\n2", "http://example.org/es/1"]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end].lower(), rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h), len(p), v, h + p) for h, p, v in RULES if p is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("copies", [1, 40])
def test_verdicts_against_plain_python(spark, copies):
    rows = [(k, u, "z") for k, u in enumerate(URLS * copies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.judge_urls(pages, rules).collect()
    assert sorted(r["page_id"] for r in got) == [r[0] for r in rows]
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(rows[r["page_id"]][1]), rows[r["page_id"]]


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    got = url_rules.judge_urls(pages, rules).first()
    assert (got["rule"], got["verdict"]) == (None, "allow")
    assert url_rules.judge_urls(pages.limit(0), spark.createDataFrame(RULES, rules.schema)).count() == 0
