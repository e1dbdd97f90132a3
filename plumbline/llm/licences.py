"""Operator 13: licence scans by a generalised suffix automaton.

The automaton takes in every template's words, one template after another, so that its states are the
runs of words that stand in some template, with the places where they end. A text is read once, word by
word: the state reached and its length are the matching statistics, the longest run of words ending here
that some template has. Where a run cannot be extended it is a match of all templates its state names.
Long matches are chained along the template and the text together; a chain that covers enough of its
template is a span, and its label holds.

The automaton has the size of the templates, whatever the texts; a text's matches are kept as long as a
chain can still reach back to them, and what a chain reaches back over is bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table, text_of
from plumbline.llm.licence_texts import PHRASES, TEMPLATES

#: Shortest match in words, most words of text or template between two matches of a chain, and the
#: hundredths of a template that a span covers. Templates of fewer than NOTICE words are covered whole.
MATCH = 4
GAP = 12
COVER = 80
NOTICE = 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """A text's words, letters A-Z lowered."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class Automaton:
    """Generalised suffix automaton over the words of several templates."""

    def __init__(self, templates: Iterable[list[bytes]]):
        self.templates = [list(t) for t in templates]
        names: dict[bytes, int] = {}
        for words in self.templates:
            for w in words:
                names.setdefault(w, len(names) + 1)
        self.ids = names
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(self.templates):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, names[w])
                while len(ends) < len(self.next):
                    ends.append(set())
                ends[last].add((t, at + 1))
        # A state ends wherever the states that continue it to the left end.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]

    def _new(self, length: int, link: int, steps: dict[int, int]) -> int:
        self.next.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the words of ``p`` and then ``c``, taken out of the longer ``q``."""
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def matches(self, words: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(end in the text, words, state) of the runs that cannot be extended to either side and have ``least`` words."""
        steps, link, length = self.next, self.link, self.length
        state = size = 0
        for at, c in enumerate(words):
            if not c:
                if size >= least:
                    yield at, size, state
                state = size = 0
                continue
            to = steps[state].get(c)
            if to is None:
                if size >= least:
                    yield at, size, state
                while state > 0 and to is None:
                    state = link[state]
                    size = length[state]
                    to = steps[state].get(c)
                if to is None:
                    state = size = 0
                    continue
            state, size = to, size + 1
        if size >= least:
            yield len(words), size, state


class Chain:
    """The best chain that ends with a match: the words it covers, its first word, and the end in text and template."""

    __slots__ = ("covered", "start", "end", "place")

    def __init__(self, covered: int, start: int, end: int, place: int):
        self.covered, self.start, self.end, self.place = covered, start, end, place


def chained(automaton: Automaton, found: Iterable[tuple[int, int, int]], gap: int) -> Iterator[tuple[int, Chain]]:
    """(template, chain) of every chain that no later match continues.

    A match continues the chain of the same template that then covers most, among those that end at most
    ``gap`` words earlier in the text and in the template; where the two overlap, the later one counts
    from where the earlier ends. Chains too far back are given out and forgotten.
    """
    open_chains: dict[int, list[Chain]] = {}
    used: dict[int, set[int]] = {}
    for end, size, state in found:
        for t, place in automaton.ends[state]:
            chains = open_chains.setdefault(t, [])
            best = Chain(size, end - size, end, place)
            before = None
            for c in chains:
                both = min(end - c.end, place - c.place)
                if 0 < both and end - size - c.end <= gap and place - size - c.place <= gap:
                    covered = c.covered + min(size, both)
                    if covered > best.covered:
                        best, before = Chain(covered, c.start, end, place), c
            if before is not None:
                used.setdefault(t, set()).add(id(before))
            chains.append(best)
        for t in list(open_chains):
            # A later match ends past this one, and no match is longer than its template.
            far = end - len(automaton.templates[t]) - gap
            if open_chains[t][0].end < far:
                for c in open_chains[t]:
                    if c.end < far and id(c) not in used.get(t, ()):
                        yield t, c
                gone = {id(c) for c in open_chains[t] if c.end < far}
                used[t] = used.get(t, set()) - gone
                open_chains[t] = [c for c in open_chains[t] if id(c) not in gone]
                if not open_chains[t]:
                    del open_chains[t]
    for t, chains in open_chains.items():
        for c in chains:
            if id(c) not in used.get(t, ()):
                yield t, c


class Scanner:
    """Templates with their labels, and phrases that are labels wherever they stand."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], match: int = MATCH, gap: int = GAP, cover: int = COVER):
        self.labels = [label for label, _ in templates]
        self.automaton = Automaton([words_of(text) for _, text in templates])
        self.match, self.gap, self.cover = match, gap, cover
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases.items():
            words = words_of(phrase)
            self.phrases.setdefault(words[-1], []).append((words, label))

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(first word, label) of every place where a phrase stands."""
        out = []
        for last, ways in self.phrases.items():
            at = -1
            for _ in range(words.count(last)):
                at = words.index(last, at + 1)
                for phrase, label in ways:
                    first = at - len(phrase) + 1
                    if first >= 0 and words[first : at + 1] == phrase:
                        out.append((first, label))
        return out

    def spans(self, words: list[bytes]) -> tuple[list[tuple[str, int, int, float]], float]:
        """(label, first word, end, share of the template) of every covered template, and the largest share of any.

        Of spans that overlap, the one that covers more words stays.
        """
        ids = list(map(self.automaton.ids.get, words))
        covering: list[tuple[int, float, int, int, str]] = []
        most = 0.0
        for t, chain in chained(self.automaton, self.automaton.matches(ids, self.match), self.gap):
            size = len(self.automaton.templates[t])
            most = max(most, chain.covered / size)
            if 100 * chain.covered >= (self.cover if size >= NOTICE else 100) * size:
                covering.append((-chain.covered, -chain.covered / size, chain.start, chain.end, self.labels[t]))
        starts: list[int] = []
        spans: list[tuple[str, int, int, float]] = []
        for _, share, start, end, label in sorted(covering):
            at = bisect_left(starts, start)
            if (at == 0 or spans[at - 1][2] <= start) and (at == len(spans) or end <= starts[at]):
                starts.insert(at, start)
                spans.insert(at, (label, start, end, -share))
        return spans, most


SPAN = "array<struct<label: string, first: bigint, end: bigint, share: double>>"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         match: int = MATCH, gap: int = GAP, cover: int = COVER) -> DataFrame:
    """doc_id, n_words, places, spans and share of every row of ``docs`` (doc_id, text).

    ``places`` are the phrases with the word they start at, ``spans`` the templates covered to ``cover``
    hundredths by chained matches of ``match`` words or more, ``share`` the largest part of any template
    that a chain covers, 1 where a phrase stands. A null text is empty: no words, no places, share 0.
    Repeated rows are scanned each; other columns are ignored.
    """

    def make():
        scanner = Scanner(templates, phrases, match, gap, cover)

        def step(batch: dict[str, list]) -> dict[str, list]:
            out = {"doc_id": batch["doc_id"], "n_words": [], "places": [], "spans": [], "share": []}
            for text in batch["text"]:
                words = words_of(text)
                places, (spans, share) = scanner.places(words), scanner.spans(words)
                out["n_words"].append(len(words))
                out["places"].append([{"first": first, "label": label} for first, label in sorted(places)])
                out["spans"].append([dict(zip(("label", "first", "end", "share"), s)) for s in spans])
                out["share"].append(1.0 if places else share)
            return out

        return step

    schema = f"doc_id bigint, n_words bigint, places array<struct<first: bigint, label: string>>, spans {SPAN}, share double"
    return map_batches(docs.select("doc_id", text_of().alias("text")), make, schema)


@query("op13_licence_spans")
def op13_licence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and covered licence texts of all documents."""
    found = scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.col("places.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.first").alias("first_word"), F.array_max("places.first").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, F.col("spans.label"))).alias("labels"), F.col("share").alias("score"), "spans")
