"""SentencePiece BPE by a table of prefixes, as plain functions that run inside tasks.

The last token of the encoding of a prefix is unique: it is the one vocabulary entry that
ends there (found by an automaton), whose start is the end of a shorter prefix, and that
may follow that prefix's own last token. Two tokens may follow each other when merging
their joined text gives just these two. So one pass over the matches fills the table, and
walking back from any prefix recovers its tokens. Next to the last token the table keeps
how many tokens the prefix has.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

from pyspark import cloudpickle

from baitline.llm.common import worker_memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
MEMO_RUNS = 250_000
MEMO_RUN_CHARS = 48
MEMO_PAIRS = 600_000


def load_vocabulary(path: str) -> dict:
    """What the coder needs of a model file: pieces, scores and kinds; bounded by the vocabulary.

    Models with other settings than BPE with byte fallback, a dummy prefix, blanks kept and
    no text normalisation are refused.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    plain = (train.model_type == 2 and train.byte_fallback and norm.add_dummy_prefix
             and not norm.remove_extra_whitespaces and norm.escape_whitespaces
             and not norm.precompiled_charsmap and not train.treat_whitespace_as_suffix)
    kinds = {p.type for p in model.pieces}
    inner = any(BLANK in p.piece.lstrip(BLANK) for p in model.pieces if p.type == 1)
    if not plain or not kinds <= {1, 2, 3, 6} or inner:
        raise ValueError(f"{path}: not a BPE model of the supported settings")
    return {"pieces": [p.piece for p in model.pieces], "scores": [p.score for p in model.pieces],
            "kinds": [p.type for p in model.pieces]}


class Coder:
    """Encodes, counts and decodes with one vocabulary; built once per Python worker."""

    def __init__(self, vocabulary: dict):
        self.pieces = vocabulary["pieces"]
        normal = [i for i, kind in enumerate(vocabulary["kinds"]) if kind == 1]
        self.id_of = {self.pieces[i]: i for i in normal}
        # A merge with a higher score comes first; equal scores share a rank.
        levels = {s: r for r, s in enumerate(sorted({vocabulary["scores"][i] for i in normal},
                                                    reverse=True))}
        self.rank = {i: levels[vocabulary["scores"][i]] for i in normal}
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces)
                        if vocabulary["kinds"][i] == 6}
        self.endings: dict = {}  # the pieces read backwards, as an automaton of nested tables
        for i in normal:
            node = self.endings
            for c in reversed(self.pieces[i]):
                node = node.setdefault(c, {})
            node[""] = i
        self.alone, self.halves = set(), {}
        for i in normal:
            parts = self._merge(self.pieces[i], stop_before_last=True)
            if len(self.pieces[i]) == 1:
                self.alone.add(i)
            elif len(parts) == 2:
                self.alone.add(i)
                self.halves[i] = (self.id_of.get(parts[0]), self.id_of.get(parts[1]))
        self.raw = [self._raw(i, kind) for i, kind in enumerate(vocabulary["kinds"])]
        self.pair_memo: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.count_memo: dict[str, int] = {}
        self.older_counts: dict[str, int] = {}

    def _raw(self, i: int, kind: int) -> bytes:
        if kind == 6:
            return bytes([int(self.pieces[i][3:5], 16)])
        if kind == 2:
            return " ⁇ ".encode()
        return b"" if kind == 3 else self.pieces[i].replace(BLANK, " ").encode()

    def _merge(self, text: str, stop_before_last: bool = False) -> list[str]:
        """Merge neighbours step by step: best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.rank[i] < best[0]):
                    best = (self.rank[i], k)
            if best is None or stop_before_last and len(parts) == 2:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """May ``right`` follow ``left``?"""
        key = left * len(self.pieces) + right
        known = self.pair_memo.get(key)
        if known is None:
            if len(self.pair_memo) >= MEMO_PAIRS:
                self.pair_memo.clear()
            known = self.pair_memo[key] = self._unwind(left, right)
        return known

    def _unwind(self, left: int, right: int) -> bool:
        """Undo the merges next to the border, latest first: was one across it due earlier?"""
        a, b = self.pieces[left], self.pieces[right]
        only_blanks = not a.strip(BLANK) and not b.strip(BLANK)
        if only_blanks or None in (self.rank.get(left), self.rank.get(right)):
            return self._merge(a + b) == [a, b]
        before = float("inf")  # merges of a lower rank than this come before the next one undone
        while True:
            across = self.id_of.get(self.pieces[left] + self.pieces[right])
            if across is not None and self.rank[across] < before:
                return False
            ways = []
            if left in self.halves:
                ways.append((self.rank[left], 1))
            if right in self.halves:
                ways.append((self.rank[right], 0))
            if not ways:
                return True
            late, is_left = max(ways)
            if len(ways) == 2 and ways[0][0] == ways[1][0]:
                return self._merge(a + b) == [a, b]
            inner = self.halves[left][1] if is_left else self.halves[right][0]
            if inner is None:
                return self._merge(a + b) == [a, b]
            # Equal rank: the leftmost comes first, so a merge across beats the right one only.
            before = late if is_left else late + 0.5
            left, right = (inner, right) if is_left else (left, inner)

    def table(self, text: str, keep: int = 0, held: tuple | None = None) -> tuple[list, list, list]:
        """Per prefix of a run: its last token, that token's length, its number of tokens.

        Token -1 is a character outside the vocabulary; it counts as its bytes. The rows of
        the first ``keep`` characters are taken over from ``held``, the table of a text with
        the same beginning.
        """
        last, size, count = held or ([-1], [0], [0])
        del last[keep + 1:], size[keep + 1:], count[keep + 1:]
        alone, pairs, base, top = self.alone, self.pair_memo, len(self.pieces), self.endings
        for i in range(keep + 1, len(text) + 1):
            node, start, found = top, i, False
            while start:  # the automaton reads backwards over all pieces that end here
                start -= 1
                node = node.get(text[start])
                if node is None:
                    break
                token = node.get("")
                if token is None:
                    continue
                before = last[start]
                if before < 0:
                    found = token in alone
                else:
                    found = pairs.get(before * base + token)
                    if found is None:
                        found = self._fits(before, token)
                if found:
                    last.append(token)
                    size.append(i - start)
                    count.append(count[start] + 1)
                    break
            if not found:
                last.append(-1)
                size.append(1)
                count.append(count[i - 1] + len(text[i - 1].encode()))
        return last, size, count

    def _recover(self, text: str, last: list[int], size: list[int]) -> bytes:
        out, i = [], len(text)
        while i:
            if last[i] >= 0:
                out.append(last[i])
            else:
                out.extend(self.byte_id[b] for b in reversed(text[i - 1].encode()))
            i -= size[i]
        return array("i", reversed(out)).tobytes()

    def _tables(self, wanted: set[str]) -> Iterator[tuple[str, tuple[list, list, list]]]:
        """Tables of many runs, in sorted order: neighbours share their beginnings.

        A table is good until the next one is asked for.
        """
        held, before = None, ""
        for text in sorted(wanted):
            keep, most = 0, min(len(text), len(before))
            while keep < most and text[keep] == before[keep]:
                keep += 1
            held = self.table(text, keep if held else 0, held)
            yield text, held
            before = text

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of runs nobody has coded yet."""
        return {text: self._recover(text, held[0], held[1]) for text, held in self._tables(wanted)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as 32-bit integers, as bytes."""
        cut = [runs(t) for t in texts]
        every = set().union(*cut)
        ids, older = self.memo, self.older
        known = {}
        for r in every:
            own = ids.get(r) or older.get(r)
            if own is not None:
                known[r] = own
        known |= self._learn(every - known.keys())
        if len(ids) + len(known) > MEMO_RUNS:
            self.older, self.memo = ids, {}
        self.memo.update((r, own) for r, own in known.items() if len(r) <= MEMO_RUN_CHARS)
        return [b"".join([known[r] for r in own]) for own in cut]

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of whole texts: the last prefix count of every run; no ids are recovered."""
        cut = [runs(t) for t in texts]
        memo, older = self.count_memo, self.older_counts
        known, new = {}, set()
        for r in set().union(*cut):
            n = memo.get(r) or older.get(r)
            if n is None:
                new.add(r)
            else:
                known[r] = n
        known.update((r, held[2][-1]) for r, held in self._tables(new))
        if len(memo) + len(known) > MEMO_RUNS:
            self.older_counts, self.count_memo = memo, {}
        self.count_memo.update((r, n) for r, n in known.items() if len(r) <= MEMO_RUN_CHARS)
        return [sum([known[r] for r in own]) for own in cut]

    def prefix_counts(self, text: str) -> list[int]:
        """Number of tokens of every prefix of a text, from 0 characters on."""
        out, held, done = [0], None, 0
        for run in runs(text):
            count = self.table(run)[2]
            out.extend(done + c for c in (count[2:] if held is None else count[1:]))
            held, done = run, done + count[-1]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes that are no UTF-8 become U+FFFD one by one, the first blank goes."""
        raw = self.raw
        joined = b"".join([raw[i] for i in ids])
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = _decode_loosely(joined)
        first = next((i for i in ids if raw[i]), None)
        dummy = first is not None and self.pieces[first][0] == BLANK
        return text[1:] if dummy else text


def _decode_loosely(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at:at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


_RUN = re.compile(f"{BLANK}+[^{BLANK}]*")


def runs(text: str) -> list[str]:
    """A text with its dummy blank, cut before every run of blanks; no piece crosses these cuts."""
    return _RUN.findall(BLANK + text.replace(" ", BLANK)) if text else []


def coder_of(vocabulary: dict, key: str) -> Coder:
    coder = worker_memo(f"coder {key}", lambda: Coder(vocabulary))
    coder.memo_key = f"coder {key}"
    return coder
