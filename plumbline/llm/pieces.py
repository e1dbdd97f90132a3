"""Operator 1: SentencePiece encoding and decoding with the N best segmentations.

The pieces that match a text form a lattice. A forward Viterbi pass gives the best score of reaching
every character; a backward A* search from the end uses those scores as its heuristic, which is
exact, so complete segmentations come off the agenda in the order of their scores. Where no piece holds
a word mark after another character, the lattice falls apart at word marks into segments: each
distinct segment is solved once a worker, and the N best of a text are the best combinations of its
segments' alternatives, of which only the N - 1 cheapest to change can matter.

Order: score, the highest first; within a segment, equal scores by the lengths of the pieces from
the end, the shorter first; among texts' combinations, by the segments' ranks from the last segment
to the first. Characters without a piece of their own become bytes, at the score of an unknown.
"""

from __future__ import annotations

import heapq
import re
from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table
from plumbline.llm.vocab import public_path

MARK = "▁"
BEST = 4
UNKNOWN_PENALTY = 10.0
#: Segments a worker's cache may hold, and the longest that goes into it.
CACHE_SEGMENTS = 1_100_000
CACHE_CHARS = 64

_OPEN: dict[str, Pieces] = {}


class Node:
    """A partial segmentation from some character to the end."""

    __slots__ = ("at", "after", "back", "length")

    def __init__(self, at: int, back: float, length: int, after: Node | None):
        self.at, self.back, self.length, self.after = at, back, length, after

    def lengths(self) -> list[int]:
        """Piece lengths in the order they were chosen, from the end of the text."""
        out, node = [], self
        while node.after is not None:
            out.append(node.length)
            node = node.after
        return out[::-1]

    def __lt__(self, other: Node) -> bool:
        return self.lengths() < other.lengths()


class Pieces:
    """A piece model: scores, ids and bytes of its pieces."""

    def __init__(self, path: str | None = None, vocabulary: list[tuple[str, float, str]] | None = None):
        """``vocabulary``: (piece, score, kind) in id order; kinds are normal, unknown, control, byte, unused."""
        rows = self._of_file(path) if vocabulary is None else vocabulary
        self.scores = {p: (s, i) for i, (p, s, kind) in enumerate(rows) if kind == "normal"}
        self.tree = self._tree()
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(rows) if kind == "byte"}
        self.unknown_id = next((i for i, r in enumerate(rows) if r[2] == "unknown"), 0)
        self.unknown = min((s for s, _ in self.scores.values()), default=0.0) - UNKNOWN_PENALTY
        kinds = {"normal": lambda p: p.encode(), "byte": lambda p: bytes([int(p[3:5], 16)]), "unknown": lambda p: " ⁇ ".encode()}
        self.bytes_of = [kinds.get(kind, lambda p: b"")(p) for p, _, kind in rows]
        self.falls_apart = not any(MARK in p.lstrip(MARK) for p in self.scores)
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if self.falls_apart else "(?s).+")
        # Signs that no piece joins to a letter before them: a word and the sign after it are solved apart.
        joined = {y for p in self.scores for x, y in zip(p, p[1:]) if x.isalpha()}
        self.closing = frozenset(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in joined)
        self.first: dict[str, tuple[bytes, float, float]] = {}
        self.ranked: dict[tuple[str, int], list[tuple[float, bytes]]] = {}

    @staticmethod
    def _of_file(path: str) -> list[tuple[str, float, str]]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  b\nﬁ "
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path} changes texts beyond marking their spaces")

        def kind(i: int) -> str:
            return next((k for k, f in (("unknown", model.is_unknown), ("control", model.is_control), ("byte", model.is_byte), ("unused", model.is_unused)) if f(i)), "normal")

        return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]

    def segments(self, text: str) -> list[str]:
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def ids(self, segment: str, lengths: list[int]) -> bytes:
        """Ids of a segmentation, its piece lengths given from the start, as unsigned 32-bit bytes."""
        out, at = array("I"), 0
        for n in lengths:
            piece = segment[at : at + n]
            at += n
            if piece in self.scores:
                out.append(self.scores[piece][1])
            else:
                out.extend(self._without_piece(piece))
        return out.tobytes()

    def forward(self, segment: str) -> tuple[list[float], list[list[tuple[int, float]]]]:
        """The best score of reaching every character, and the pieces (start, score) that end at each."""
        n = len(segment)
        reach = [0.0] + [float("-inf")] * n
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            base = reach[i]
            for j, s in self._pieces_at(segment, i):
                ending[j].append((i, s))
                if base + s > reach[j]:
                    reach[j] = base + s
        return reach, ending

    def _tree(self) -> dict[str, tuple]:
        """Pieces by their characters: a node is (score or None, nodes by next character, id)."""
        tree: dict = {}
        for piece, (score, number) in self.scores.items():
            nodes = tree
            for c in piece[:-1]:
                nodes = nodes.setdefault(c, [None, {}, None])[1]
            nodes.setdefault(piece[-1], [None, {}, None])[::2] = score, number

        def fixed(nodes: dict) -> dict[str, tuple]:
            return {c: (score, fixed(after), number) for c, (score, after, number) in nodes.items()}

        return fixed(tree)

    def _pieces_at(self, segment: str, i: int) -> list[tuple[int, float]]:
        """Ends and scores of the pieces that begin at a character; an unknown where no single one does."""
        out, j, node = [], i + 1, self.tree.get(segment[i])
        if node is None or node[0] is None:
            out.append((j, self.unknown))
        while node is not None:
            if node[0] is not None:
                out.append((j, node[0]))
            if j == len(segment):
                break
            node, j = node[1].get(segment[j]), j + 1
        return out

    def solve(self, segment: str) -> tuple[bytes, float, float]:
        """Ids and score of the best segmentation, and what the second best loses against it.

        The forward pass alone, with the two best scores of reaching every character; it runs once for
        every distinct segment, so its loop is written out.
        """
        n, tree, unknown, least = len(segment), self.tree, self.unknown, float("-inf")
        reach, second, back, number = [0.0] + [least] * n, [least] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        for i, c in enumerate(segment):
            base, base_second, j, node = reach[i], second[i], i + 1, tree.get(c)
            if node is None or node[0] is None:
                v, old = base + unknown, reach[j]
                if v >= old:
                    other = base_second + unknown
                    second[j] = old if old > other else other
                    reach[j], back[j], number[j] = v, i, None
                elif v > second[j]:
                    second[j] = v
            while node is not None:
                s, after, k = node
                if s is not None:
                    v, old = base + s, reach[j]
                    if v >= old:
                        other = base_second + s
                        second[j] = old if old > other else other
                        reach[j], back[j], number[j] = v, i, k
                    elif v > second[j]:
                        second[j] = v
                if j == n:
                    break
                node, j = after.get(segment[j]), j + 1
        out, at = [], n
        while at:
            k = number[at]
            out.extend([k] if k is not None else self._without_piece(segment[back[at] : at])[::-1])
            at = back[at]
        return array("I", out[::-1]).tobytes(), reach[n], reach[n] - second[n]

    def _without_piece(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode("utf-8", "replace")] if self.byte_ids else [self.unknown_id]

    def _learn(self, segment: str) -> tuple[bytes, float, float]:
        """``solve`` of a segment, kept for the next time."""
        if len(segment) > 1 and segment[-1] in self.closing and segment[-2].isalpha():
            word, sign = segment[:-1], segment[-1]
            (ids, score, loss), (sign_ids, sign_score, sign_loss) = (self.first.get(x) or self._learn(x) for x in (word, sign))
            known = ids + sign_ids, score + sign_score, min(loss, sign_loss)
        else:
            known = self.solve(segment)
        if len(segment) <= CACHE_CHARS:
            self.first[segment] = known
        return known

    def search(self, segment: str, best: int) -> list[tuple[float, list[int]]]:
        """Scores and piece lengths of the ``best`` segmentations of one segment, by backward A*."""
        reach, ending = self.forward(segment)
        agenda = [(-reach[-1], Node(len(segment), 0.0, 0, None))]
        out: list[tuple[float, list[int]]] = []
        while agenda and len(out) < best:
            estimate, node = heapq.heappop(agenda)
            if not node.at:
                out.append((-estimate, node.lengths()[::-1]))
                continue
            for i, s in ending[node.at]:
                back = node.back + s
                heapq.heappush(agenda, (-(reach[i] + back), Node(i, back, node.at - i, node)))
        return out

    def alternatives(self, segment: str, best: int) -> list[tuple[float, bytes]]:
        """What each of the ``best`` segmentations loses against the first, and its ids."""
        known = self.ranked.get((segment, best))
        if known is None:
            found = self.search(segment, best)
            known = [(found[0][0] - score, self.ids(segment, lengths)) for score, lengths in found]
            if len(segment) <= CACHE_CHARS:
                self.ranked[segment, best] = known
        return known

    def encode(self, text: str, best: int = 1) -> list[tuple[float, bytes]]:
        """Scores and ids of the ``best`` segmentations of a text; one empty one for an empty text."""
        first = self.first
        if len(first) > CACHE_SEGMENTS or len(self.ranked) > CACHE_SEGMENTS:
            first.clear()
            self.ranked.clear()
        segments = self.segments(text)
        solved = list(map(first.get, segments))
        if None in solved:
            solved = [known or first.get(segment) or self._learn(segment) for segment, known in zip(segments, solved)]
        if not solved:
            return [(0.0, b"")]
        parts, scores, losses = zip(*solved)
        score = float(sum(scores))
        if best == 1:
            return [(score, b"".join(parts))]
        ids = list(parts)
        # Later segments first, as ties compare the ranks from the last segment.
        limit = heapq.nsmallest(best - 1, losses)[-1]
        cheap = [p for p, loss in enumerate(losses) if loss <= limit and loss != float("inf")]
        change = sorted(sorted(cheap, key=losses.__getitem__)[: best - 1], reverse=True)
        options = [self.alternatives(segments[p], best) for p in change]
        agenda, seen = [(0.0, (0,) * len(change))], set()
        out = []
        while agenda and len(out) < best:
            loss, ranks = heapq.heappop(agenda)
            for p, option, r in zip(change, options, ranks):
                ids[p] = option[r][1]
            out.append((score - loss, b"".join(ids)))
            for k, option in enumerate(options):
                if ranks[k] + 1 < len(option):
                    more = (*ranks[:k], ranks[k] + 1, *ranks[k + 1 :])
                    if more not in seen:
                        seen.add(more)
                        heapq.heappush(agenda, (sum(o[r][0] for o, r in zip(options, more)), more))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids as unsigned 32-bit bytes."""
        marked = b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")
        return marked.replace(MARK, " ").removeprefix(" ")


def pieces(path: str) -> Pieces:
    """This worker's model of a file."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]


def encode(docs: DataFrame, path: str, best: int = BEST) -> DataFrame:
    """doc_id, rank, score, ids and round_trip: the ``best`` segmentations of every text.

    ``ids`` are unsigned little-endian 32-bit numbers; ``round_trip`` tells whether they decode to the
    text. A null text is empty; an empty text has one segmentation without pieces. A text with fewer
    segmentations than ``best`` has fewer rows. Equal rows are encoded each; other columns are ignored.
    """

    def make():
        model = pieces(path)

        def step(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": [], "rank": [], "score": [], "ids": [], "round_trip": []}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = model.encode(text or "", best)
                # All segmentations of a text hold the same characters, so they decode alike.
                same = model.decode(found[0][1]) == (text or "")
                for rank, (score, ids) in enumerate(found, 1):
                    out["doc_id"].append(doc_id)
                    out["rank"].append(rank)
                    out["score"].append(score)
                    out["ids"].append(ids)
                    out["round_trip"].append(same)
            return out

        return step

    return map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, rank int, score double, ids binary, round_trip boolean")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, rank and the text of ``ids`` of every row; null ids give a null text."""

    def make():
        model = pieces(path)

        def step(batch: dict[str, list]) -> dict[str, list]:
            return {**{c: batch[c] for c in ("doc_id", "rank")}, "text": [None if i is None else model.decode(i) for i in batch["ids"]]}

        return step

    return map_batches(rows.select("doc_id", "rank", "ids"), make, "doc_id bigint, rank int, text string")


@query("op1_piece_segmentations")
def op1_piece_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of all documents."""
    found = encode(table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))
    size = (F.octet_length("ids") / 4).cast("bigint")
    return found.select("doc_id", "rank", "score", size.alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "round_trip")
