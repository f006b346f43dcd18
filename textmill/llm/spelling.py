"""Spelling variants by composing the vocabulary's acceptor with a one-edit transducer and the acceptor again.

Two words are near if one inserted, deleted or replaced symbol makes one of the other. The composed machine has two
layers: before the edit both sides are in the same state; after it they read the same symbols to their ends.

1. **Vocabulary.** Runs of letters are counted by a hash aggregate, combined in the map tasks.
2. **Partitions.** A partition holds the words with one beginning, the symbols that lead from the initial state to a state
   of its own. Beginnings are lengthened where a partition exceeds ``PARTITION_SYMBOLS``, until none does, so a
   beginning that very many words share is split, whatever its share.
3. **Edit within a partition.** Its words become a minimised acyclic automaton, and the accepted pairs of the
   composition are enumerated: every path before the edit, every edit at its state that both sides survive, every
   common ending. Only the words' totals leave the task.
4. **Edit within the beginnings.** The two sides are then in different partitions and have to agree in all other
   symbols, so they meet by a digest of these. Words that agree in all but one symbol at one place are no more than the
   alphabet.

The edit of a pair stands at the first place where its words differ, so every pair is found once, in one of the two ways.

Edge cases: a null text has no words; a null id is written as nothing when words are damaged; words of any length are
handled, an automaton takes memory in proportion to a partition; equal counts are ordered by code point; repeated rows
count as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import pick
from textmill.storage import stage_table

LETTERS = r"A-Za-z\x{C0}-\x{FF}"
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
DAMAGED = 31  # one run in so many loses a symbol
FIRST_BEGINNING = 3
PARTITION_SYMBOLS = 1 << 18
_ROUNDS = 5  # of doubling: counts grow tenfold from form to form and have 64 bits, so 19 steps end every chain
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEAR = "word string, n_near long, best struct<less: long, word: string>"


class Acceptor:
    """The minimal acyclic automaton of words given in order. State 0 is the initial one."""

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        self._twins: dict[tuple, int] = {}
        self._spare: list[int] = []
        path, last = [0], ""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            self._settle(path, last, shared)
            for symbol in word[shared:]:
                state = self._new()
                self.arcs[path[-1]][symbol] = state
                path.append(state)
            self.final[path[-1]] = True
            last = word
        self._settle(path, last, 0)

    def _new(self) -> int:
        if self._spare:
            return self._spare.pop()
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def _settle(self, path: list[int], word: str, depth: int) -> None:
        """No word to come passes the states below ``depth``: each is merged with one that accepts the same, if any."""
        while len(path) - 1 > depth:
            state = path.pop()
            twin = self._twins.setdefault((self.final[state], *self.arcs[state].items()), state)
            if twin != state:
                self.arcs[path[-1]][word[len(path) - 1]] = twin
                self.arcs[state], self.final[state] = {}, False
                self._spare.append(state)


class OneEdit:
    """The acceptor composed with a one-edit transducer and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self._arcs, self._final = acceptor.arcs, acceptor.final
        self._meet: dict[tuple[int, int], bool] = {}
        self._edits: dict[int, list[tuple[str, str, str]]] = {}

    def _both(self, x: int, y: int, unless: str = "") -> list[tuple[str, int, int]]:
        """Arcs that both states have."""
        a, b = self._arcs[x], self._arcs[y]
        return [(s, a[s], b[s]) for s in a if s != unless and s in b]

    def _meets(self, x: int, y: int) -> bool:
        """Do both states accept some common ending?"""
        pending = [(x, y)]
        while pending:
            x, y = pair = pending[-1]
            if pair not in self._meet:
                if x == y or (self._final[x] and self._final[y]):
                    self._meet[pair] = True
                else:
                    after = [p[1:] for p in self._both(x, y)]
                    unknown = [p for p in after if p not in self._meet]
                    if unknown and not any(self._meet.get(p) for p in after):
                        pending.append(unknown[0])
                        continue
                    self._meet[pair] = any(self._meet.get(p) for p in after)
            pending.pop()
        return self._meet[pair]

    def _endings(self, x: int, y: int, unless: str = "") -> Iterator[str]:
        """All common endings of both states that do not begin with ``unless``."""
        path: list[str] = []
        pending = [(0, "", x, y)]
        while pending:
            depth, symbol, x, y = pending.pop()
            if depth:
                path[depth - 1 :] = [symbol]
            if self._final[x] and self._final[y]:
                yield "".join(path)
            for symbol, a, b in self._both(x, y, "" if depth else unless):
                if self._meets(a, b):
                    pending.append((depth + 1, symbol, a, b))

    def edits(self, state: int) -> list[tuple[str, str, str]]:
        """(left symbol, right symbol, ending) of all pairs that take their edit at ``state``; no left symbol: inserted."""
        if state not in self._edits:
            arcs = sorted(self._arcs[state].items())
            found = []
            for k, (a, x) in enumerate(arcs):
                # What is inserted differs from what follows, or the words would still agree here.
                found += [("", a, end) for end in self._endings(state, x, a)]
                for b, y in arcs[k + 1 :]:
                    if self._meets(x, y):
                        found += [(a, b, end) for end in self._endings(x, y)]
            self._edits[state] = found
        return self._edits[state]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All pairs of accepted words that are one edit apart, each once."""
        path: list[str] = []
        pending = [(0, "", 0)]
        while pending:
            depth, symbol, state = pending.pop()
            if depth:
                path[depth - 1 :] = [symbol]
            if edits := self.edits(state):
                begin = "".join(path)
                for a, b, end in edits:
                    yield begin + a + end, begin + b + end
            pending.extend((depth + 1, s, to) for s, to in self._arcs[state].items())


def near_totals(words: list[str], counts: list[int], beginning: int) -> list[tuple[str, int, int, str]]:
    """(word, near words, their largest count, that word) for words that share their first ``beginning`` symbols."""
    n = dict(zip(words, counts))
    totals: dict[str, tuple[int, int, str]] = {}
    begin = words[0][:beginning]
    for a, b in OneEdit(Acceptor(sorted(w[beginning:] for w in words))).pairs():
        for one, other in ((begin + a, begin + b), (begin + b, begin + a)):
            near, less, best = totals.get(one, (0, 1, ""))
            totals[one] = (near + 1, *min((less, best), (-n[other], other)))
    return [(word, near, -less, best) for word, (near, less, best) in totals.items()]


def _near_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by beginning; each partition is handled once it is complete."""
    words: list[str] = []
    counts: list[int] = []
    now: str | None = None

    def close() -> pa.RecordBatch:
        found = near_totals(words, counts, len(now))
        best = pa.StructArray.from_arrays(
            [pa.array([-f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.string())], names=["less", "word"]
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), best],
            names=["word", "n_near", "best"],
        )

    for batch in batches:
        for begin, word, n in zip(*(batch.column(c).to_pylist() for c in ("beginning", "word", "n"))):
            if begin != now:
                if len(words) > 1:
                    yield close()
                words, counts, now = [], [], begin
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield close()


def count_words(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters, one in ``DAMAGED`` without one of its symbols, by the CRC-32 of id and run."""
    picked = pick(docs, id=id_col, text=text_col)
    # No shorter run gives a word. Runs are maximal: a match begins where the one before ended or no letter stands.
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}+"), F.lit(0))
    word, h, length = F.col("word"), F.col("h"), F.length("word")
    id_text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    found = picked.select(id_text.alias("id"), F.explode(runs).alias("word"))
    found = found.select("id", F.translate("word", _UPPER, _LOWER).alias("word"))
    found = found.select("word", F.crc32(F.concat("id", F.lit(":"), "word")).alias("h"))
    at = (h % length).cast("int")
    damaged = F.concat(F.left(word, at), F.substring(word, at + 2, length))
    found = found.select(F.when(h % DAMAGED == 0, damaged).otherwise(word).alias("word"))
    counted = found.filter(length >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def with_beginnings(words: DataFrame, most: int = PARTITION_SYMBOLS, first: int = FIRST_BEGINNING) -> DataFrame:
    """Add ``beginning``: the shortest tried that no more than ``most`` symbols of words share.

    A word that is no longer than the beginning tried is a partition by itself; the others lengthen theirs by a third.
    """
    done, rest, size = [], words, first
    while True:
        begun = rest.withColumn("beginning", F.left("word", F.lit(size)))
        large = begun.groupBy("beginning").agg(F.sum(F.length("word")).alias("_symbols"), F.count(F.lit(1)).alias("_words"))
        large = stage_table(large.filter((F.col("_symbols") > most) & (F.col("_words") > 1)).select("beginning"), "beginnings")
        if large.isEmpty():
            done.append(begun)
            break
        done.append(begun.join(large, "beginning", "left_anti").select(*begun.columns))
        rest = stage_table(begun.join(large, "beginning", "left_semi").select(*words.columns), "beginnings-rest")
        size += max(1, size // 3)
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found


def _met_outside(begun: DataFrame) -> DataFrame:
    """Totals of pairs whose edit lies in the beginnings, so in different partitions."""
    word, place = F.col("word"), F.col("place")
    digest = lambda kind, text: F.unhex(F.md5(F.concat(kind, F.lit(":"), text)))
    without = F.concat(F.left(word, place), F.substring(word, place + 2, F.length(word)))
    symbol = lambda k: F.substring(word, k + 1, F.lit(1))
    cut = begun.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("beginning") - 1)).alias("place"))
    cut = cut.select("word", "n", "place", without.alias("without"), (symbol(place) != symbol(place + 1)).alias("run_ends"))
    replaced = cut.select(digest(F.col("place").cast("string"), F.col("without")).alias("key"), F.lit(0).alias("kind"), "word", "n")
    shorter = cut.filter("run_ends").select(digest(F.lit("="), F.col("without")).alias("key"), F.lit(1).alias("kind"), "word", "n")
    whole = begun.select(digest(F.lit("="), word).alias("key"), F.lit(2).alias("kind"), "word", "n")
    keyed = replaced.unionByName(shorter).unionByName(whole)
    met = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("kind").alias("kind"),
        F.max("kind").alias("last"),
        F.collect_list(F.struct((-F.col("n")).alias("less"), "word", F.col("kind").alias("is"))).alias("all"),
    )
    # Words that only share a shorter word which isn't listed are two edits apart.
    met = met.filter("size > 1 and (kind = 0 or (kind = 1 and last = 2))").withColumn("all", F.array_sort("all"))
    member = F.col("member")
    met = met.select("size", "kind", "all", F.explode("all").alias("member"))
    others = F.when(F.col("kind") == 0, F.filter("all", lambda x: x["word"] != member["word"]))
    others = others.otherwise(F.filter("all", lambda x: x["is"] != member["is"]))
    met = met.select(member["word"].alias("word"), others.alias("others"))
    best = F.get("others", F.lit(0))
    return met.select(
        "word", F.size("others").cast("long").alias("n_near"), F.struct(best["less"].alias("less"), best["word"].alias("word")).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by doubling."""
    links = stage_table(forms.select("word", F.col("form").alias("up")), "forms")
    for _ in range(_ROUNDS):
        above = links.select(F.col("word").alias("_w"), F.col("up").alias("_u"))
        step = links.join(above, links["up"] == F.col("_w"), "left")
        links = stage_table(step.select("word", F.coalesce("_u", "up").alias("up")), "forms")
    return links.withColumnRenamed("up", "root")


def group_variants(words: DataFrame, form_ratio: int = FORM_RATIO, most: int = PARTITION_SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct ``words`` (word, n).

    A word's form is its near word of largest count (ties: the first in code-point order) if that is ``form_ratio`` times
    the word's; its root is where the forms lead.
    """
    words = stage_table(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    begun = stage_table(with_beginnings(words, most), "spelling-partitions")
    dealt = begun.repartition("beginning").sortWithinPartitions("beginning", "word")
    inside = dealt.mapInArrow(_near_batches, NEAR)
    near = inside.unionByName(_met_outside(begun)).withColumn("n", F.lit(None).cast("long"))
    own = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less: long, word: string>").alias("best"), "n")
    rated = near.unionByName(own).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    is_form = -F.col("best.less") >= F.col("n") * form_ratio
    rated = rated.select(
        "word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    rated = stage_table(rated, "spelling-rated")
    roots = _roots(rated.filter("form is not null"))
    return rated.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spelling variants among the words of ``docs``."""
    return group_variants(count_words(docs, id_col, text_col))
