"""A unigram vocabulary of a SentencePiece model, and exact Viterbi over it.

The best path maximises the sum of piece scores. For each end position the pieces that end there are tried from the
longest to the shortest and only a strictly better one replaces the one before, which is the rule of the library: on
a tie the piece that starts first wins. A character that is no piece of its own may be taken as unknown, at the
smallest score less ten; with byte fallback it then gives one id per UTF-8 byte, else neighbouring unknowns share one id.

Scores are added in double precision and from the last forced boundary on, so they are exact for whole-number scores.
The library adds them in single precision over the whole text, which rounds once the sum passes 2**24; on texts below
that both agree (tested).

A boundary between two characters that stand side by side in no piece is forced: no path crosses it. Texts are cut
there, and the results of short spans are remembered (bounded), since words come back.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import ahocorasick
import numpy as np
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from kerbflow.llm.common import Memo, resident

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
WHOLE = 1 << 20
SHORT, NEVER = 64, float("-inf")


class Pieces:
    def __init__(self, model_path: str):
        with open(model_path, "rb") as file:
            self.proto = file.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(self.proto)
        spec, kinds = model.normalizer_spec, model.SentencePiece
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.normalise_by_library = None if self.plain else sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        self.unknown_id = next((i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN), 0)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_fallback = len(self.bytes) == 256
        normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL and p.piece]
        self.unknown_score = min((s for _, _, s in normal), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _, _ in normal), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in normal:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        inner = {c for p, _, _ in normal if len(p) > 1 for c in p} - {SPACE}
        crosses = any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in normal)
        letters = "[" + re.escape("".join(sorted(inner))) + "]" if inner else "(?!)"
        outer = "[^" + re.escape("".join(sorted(inner))) + SPACE + "]"
        #: Spans between forced boundaries; the whole text where the vocabulary has none, or unknowns are merged.
        forced = f"{SPACE}*{letters}+|{SPACE}+|{outer}"
        self.cut = re.compile(forced if self.byte_fallback and not crosses else r"(?s:.+)")
        self.surface = self._surfaces(model, kinds)
        self.singles = {p for p, _, _ in normal if len(p) == 1}
        self.counts = Memo(self.count_span, limit=200_000)
        self.ids = Memo(self.ids_of_span, limit=180_000)

    @staticmethod
    def _surfaces(model, kinds) -> list[bytes]:
        """What each id stands for; control ids stand for nothing."""
        out = []
        for p in model.pieces:
            if p.type == kinds.BYTE:
                out.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kinds.CONTROL:
                out.append(b"")
            elif p.type == kinds.UNKNOWN:
                out.append(" ⁇ ".encode())
            else:
                out.append(p.piece.replace(SPACE, " ").encode())
        return out

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if self.plain:
            return self.prefix + text.replace(" ", SPACE)
        return self.normalise_by_library.normalize(text)

    def spans(self, text: str) -> list[str] | Iterator[str]:
        normal = self.normalise(text)
        if len(normal) < WHOLE:
            return self.cut.findall(normal)
        return (m.group() for m in self.cut.finditer(normal))

    # --- count only -----------------------------------------------------------------------------

    def count(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.spans(text)))

    def count_span(self, span: str) -> int:
        """Pieces on the best path. Per position only its best score and number of pieces are kept.

        Only the last ``longest`` positions can start a piece, so they are held in a ring; a short span without a
        character that could be unknown needs neither the ring nor that case.
        """
        if len(span) <= SHORT and self.singles.issuperset(span):
            best, pieces = [0.0] + [NEVER] * len(span), [0] * (len(span) + 1)
            for last, (length, _, score) in self.automaton.iter(span):
                score += best[last + 1 - length]
                if score > best[last + 1]:
                    best[last + 1], pieces[last + 1] = score, pieces[last + 1 - length] + 1
            return pieces[-1]
        size = self.longest + 1
        best, pieces, merged = [0.0] * size, [0] * size, [False] * size
        hits = self.automaton.iter(span)
        hit = next(hits, None)
        for end, letter in enumerate(span, 1):
            top, number, single, unknown = None, 0, False, False
            while hit is not None and hit[0] == end - 1:
                length, _, score = hit[1]
                start = (end - length) % size
                score += best[start]
                if top is None or score > top:
                    top, number = score, pieces[start] + 1
                single = single or length == 1
                hit = next(hits, None)
            if not single:
                start = (end - 1) % size
                score = best[start] + self.unknown_score
                if top is None or score > top:
                    top, unknown = score, True
                    if self.byte_fallback:
                        number = pieces[start] + len(letter.encode())
                    else:
                        number = pieces[start] + (not merged[start])
            at = end % size
            best[at], pieces[at], merged[at] = top, number, unknown
        return pieces[len(span) % size]

    # --- ids ------------------------------------------------------------------------------------

    def ids_of_span(self, span: str) -> bytes:
        """The ids of a span as 32-bit numbers."""
        return array("i", chain.from_iterable(self.commits(span))).tobytes()

    def stream(self, span: str) -> Iterator[int]:
        """Ids of the best path, given out as soon as they are certain."""
        return chain.from_iterable(self.commits(span))

    def commits(self, span: str) -> Iterator[list[int]]:
        """The ids of the best path in runs, each given out when it is certain.

        Held are the positions since the last commit. When more than four times ``longest`` have come together,
        the paths of all positions where a piece may still start are followed back to the boundary on which they meet;
        up to there the ids are final. What is held grows past that only while they do not meet. The rest comes at the
        end, and so does a span that is shorter than that.
        """
        return self._commits_known(span) if self.singles.issuperset(span) else self._commits(span)

    def _commits_known(self, span: str) -> Iterator[list[int]]:
        """For spans in which every character is a piece, so that each position is the end of some match."""
        base, best, came = 0, [0.0], [(0, -1, 0.0)]
        limit = 4 * self.longest
        for last, match in self.automaton.iter(span):
            end = last + 1 - base
            score = match[2] + best[end - match[0]]
            if end < len(best):
                if score > best[end]:
                    best[end], came[end] = score, match
                continue
            if end > limit:
                cut = self._meeting(came)
                if cut:
                    yield self._ids_known(came, cut)
                    base, score = base + cut, score - best[cut]
                    best, came = [b - best[cut] for b in best[cut:]], came[cut:]
                limit = len(best) + 4 * self.longest
            best.append(score)
            came.append(match)
        yield self._ids_known(came, len(came) - 1)

    @staticmethod
    def _ids_known(came: list[tuple[int, int, float]], end: int) -> list[int]:
        ids = []
        while end:
            length, i, _ = came[end]
            ids.append(i)
            end -= length
        return ids[::-1]

    def _commits(self, span: str) -> Iterator[list[int]]:
        hits = self.automaton.iter(span)
        hit = next(hits, None)
        base, best, came = 0, [0.0], [(0, -1, "")]
        limit = 4 * self.longest
        before_unknown = False
        for end, letter in enumerate(span, 1):
            top, step, single = None, None, False
            while hit is not None and hit[0] == end - 1:
                length, i, score = hit[1]
                score += best[end - length - base]
                if top is None or score > top:
                    top, step = score, (length, i, "")
                single = single or length == 1
                hit = next(hits, None)
            if not single:
                score = best[-1] + self.unknown_score
                if top is None or score > top:
                    top, step = score, (1, self.unknown_id, letter)
            best.append(top)
            came.append(step)
            if len(best) > limit:
                cut = self._meeting(came)
                if cut:
                    yield self._ids(came, cut, before_unknown)
                    before_unknown = bool(came[cut][2])
                    base += cut
                    best = [b - best[cut] for b in best[cut:]]
                    came = came[cut:]
                limit = len(best) + 4 * self.longest
        yield self._ids(came, len(came) - 1, before_unknown)

    def _meeting(self, came: list[tuple]) -> int:
        """The last boundary that the paths of all live positions share."""
        last = len(came) - 1
        live = set(range(max(0, last - self.longest + 1), last + 1))
        while len(live) > 1:
            far = max(live)
            live.remove(far)
            live.add(far - came[far][0])
        return live.pop()

    def _ids(self, came: list[tuple[int, int, str]], end: int, before_unknown: bool = False) -> list[int]:
        """Ids of the path to ``end``; an unknown character is its bytes, or one id for a run of them."""
        steps = []
        while end > 0:
            steps.append(came[end])
            end -= came[end][0]
        ids = []
        for _, i, letter in reversed(steps):
            if not letter:
                ids.append(i)
            elif self.byte_fallback:
                ids.extend(self.bytes[b] for b in letter.encode())
            elif not before_unknown:
                ids.append(i)
            before_unknown = bool(letter)
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), dtype="i4")

    def encode_bytes(self, text: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.spans(text)))

    @cached_property
    def _one(self):
        return self.surface.__getitem__

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD, the space put before the text goes."""
        text = b"".join(map(self._one, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def load_pieces(model_path: str) -> Pieces:
    return resident(("pieces", model_path), lambda: Pieces(model_path))
