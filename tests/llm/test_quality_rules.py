"""Quality rules against plain loops and on edge cases."""

import re

from textmill.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


TEXTS = [
    None,
    "",
    " \n\t\n",
    "one two",
    "a b c a b c d",
    "a a a a a a",
    "x # $ <y>\nx # $ <y>\n\nx # $ <y> ",
    "ß é 漢字 \x0b 🎈 word\r\nword",
    " ".join(f"w{i}" for i in range(60)),
    "very long " * 30_000,
    "\n".join(["same line here", "other", "same line here"] * 7),
]


def test_counts_equal_plain_loops(frame, clashing):
    docs = clashing(frame(list(enumerate(TEXTS)) + [(3, "one two"), (None, "null id")]))
    got = {}
    for r in q.rate_documents(docs).collect():
        got.setdefault(r.id, []).append(
            (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        )
        assert not (r.base_failed and r.kept)
    short = [t for t in TEXTS if t is None or len(t) < 10_000]
    for i, text in enumerate(TEXTS):
        if text in short:
            assert got[i][0] == expected(text)
    assert got[9][0] == (60_000, 240_000 + 0, 0, 0, 60_000, True)
    assert len(got[3]) == 2 and len(got[None]) == 1


def body(i, n=60):
    return " ".join(f"word{i}x{k}" for k in range(n))


def test_frequent_lines_go_and_depleted_documents_are_rejected(frame):
    boiler = " ".join(f"legal{k}" for k in range(55))
    rows = [(i, boiler.upper() + "\n" + body(i) + "\n" + body(i + 1000)) for i in range(30)]
    rows += [(100 + i, boiler + "  \nlittle else " + str(i)) for i in range(5)]
    rows += [(200 + i, body(7777), "s") for i in range(40)]  # copies don't make their own lines boilerplate
    rows += [(300, boiler, "other"), (301, None, None)]
    rated = {r.id: r for r in q.rate_documents(frame(rows), max_line_docs=20, max_line_per_mille=5).collect()}
    assert rated[0].removed is None and rated[0].kept  # the host's first
    assert all(rated[i].removed == [0] and rated[i].kept for i in range(1, 30))
    assert not any(rated[100 + i].kept for i in range(5))
    assert all(rated[200 + i].kept for i in range(40))
    assert rated[300].kept and not rated[301].kept
    kept = {r.doc_id: r.text for r in q.keep_documents(frame(rows)).collect()}
    assert kept[1] == body(1) + "\n" + body(1001) and kept[0].startswith("LEGAL0") and 100 not in kept


def test_below_the_limits_nothing_is_removed(frame):
    rows = [(i, "shared line of words\n" + body(i)) for i in range(20)]
    assert all(r.removed is None for r in q.rate_documents(frame(rows)).collect())


def test_empty_table(frame):
    assert q.rate_documents(frame([])).isEmpty() and q.keep_documents(frame([])).isEmpty()


def test_documents_that_are_nearly_all_boilerplate_are_counted_one_by_one(frame):
    licence = " ".join(f"permission{k}" for k in range(58))
    rows = [(i, licence + "\n" + " ".join(f"w{i}k{k}" for k in range(12))) for i in range(500)]
    rows += [(1000 + i, licence + "\nsame end") for i in range(30)]  # copies of one document
    rated = {r.id: r for r in q.rate_documents(frame(rows)).collect()}
    assert rated[0].kept and rated[0].removed is None  # the host's first
    assert [i for i in rated if rated[i].kept] == [0]
    lines = q.text_counts(frame(rows), "doc_id", "text", "source").select("host", "content", "id")
    assert lines.select("content").distinct().count() == 501


def test_a_line_in_very_many_documents_goes_in_a_host_of_any_size(frame):
    docs = frame([(i, body(i) + ("\nthe same line again" if i < 30 else "")) for i in range(120)])
    left = lambda **limits: {r.id for r in q.rate_documents(docs, max_line_per_mille=500, **limits).filter("removed is not null").collect()}
    assert left() == set()
    assert left(always_line_docs=25) == set(range(1, 30))
