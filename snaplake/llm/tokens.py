"""Whole-text encoding with a ``tokenizers`` vocabulary file, fast on long corpora.

A byte-level BPE splits a text into pieces before merging, and a piece never
spans a blank or line break that is followed by a visible character. Texts are
cut there, and the ids of each distinct piece are encoded once per worker and
kept in a bounded table; the joined result equals encoding the whole text.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import islice

import numpy as np

from snaplake.llm.common import hold

END_ID = 2
PIECES_KEPT = 800_000
WORDS_KEPT = 200_000
TOGETHER = 3000  # words encoded at a time
LINE_BREAK = 198  # the id of a lone line break in the byte-level vocabulary
ENDINGS = ".,!?|%$&*#;:"
_ODD = re.compile(r"[ \n](?:\s|\Z)")
_CUT = re.compile(r"(?=[ \n]\S)")
_BLANK = re.compile(r"\s")
_ENDS = frozenset(ENDINGS)
LATIN = "\u024f"  # letters up to here are letters in every version of Unicode


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for what
    follows U+0100; a line break stays, as it parts words here."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(256 + i) for i, b in enumerate(others) if b != 10}


_SHOWN = _byte_alphabet()


class Encoder:
    """``many(texts)`` are the ids of each whole text as numpy arrays."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}  # by what follows a blank, or a line break and what follows it
        self.words: dict[str, bytes] = {}  # marks, and words after a line break, by the exact text
        self.lone = self._encode("\n") if self._ids("\n") == [LINE_BREAK] else None
        self.plain = self._plain_encoder(path)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, text: str) -> bytes:
        return np.array(self._ids(text), self.width).tobytes()

    @staticmethod
    def _cut(text: str) -> list[str]:
        """The first piece as it is, then pieces without the blank before them."""
        if _ODD.search(text) is None:
            return text.replace("\n", " \n").split(" ")
        first, *rest = _CUT.split(text)
        if first[:1] in (" ", "\n") and first[1:2] and not first[1].isspace():
            first, rest = "", [first, *rest]
        return [first, *(p[1:] if p[0] == " " else p for p in rest)]

    def _plain_encoder(self, path: str):
        """The same vocabulary without the search for pieces, for words of ASCII letters or digits
        alone, which are one piece and stand for themselves in the byte-level alphabet; None
        where a vocabulary file does more than that to a word."""
        from tokenizers import Tokenizer, pre_tokenizers

        told = json.loads(self.tokenizer.to_str())
        split, marks = told["pre_tokenizer"] or {}, [t["content"] for t in told["added_tokens"]]
        if (self.lone is None or told["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex", True) or any(m.strip().isalnum() for m in marks)):
            return None
        plain = Tokenizer.from_file(path)
        plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        return plain

    def _split_at_breaks(self, encoder, text: str, n: int) -> list[bytes] | None:
        """The ids of ``n`` words told apart at the line breaks between them."""
        ids = np.array(encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)
        breaks = np.flatnonzero(ids == LINE_BREAK) * self.width.itemsize
        if len(breaks) != n - 1:
            return None
        raw, step = ids.tobytes(), self.width.itemsize
        return [raw[x:y] for x, y in zip([0, *(breaks + step).tolist()], [*breaks.tolist(), len(raw)])]

    def _learn_words(self, table: dict[str, bytes], new: list[str], lead: str) -> None:
        """Put into ``table`` the ids of each of ``new`` after ``lead``: encoded together, a line
        each, and told apart at the line breaks."""
        if self.plain is not None:
            hard = [w for w in new if not w.isascii() or not (w.isalpha() or w.isdigit())]
            other = set(hard)
            easy = [w for w in new if w not in other] if hard else new
            latin = [w for w in hard if w.isalpha() and max(w) <= LATIN]
            hard = [w for w in hard if not (w.isalpha() and max(w) <= LATIN)]
            shown = "\u0120" if lead else ""  # a blank in the byte-level alphabet; \u010a is a line break
            for part in [x[at:at + TOGETHER] for x in (easy, latin) for at in range(0, len(x), TOGETHER)]:
                text = "\n".join(part)
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(_SHOWN)
                got = self._split_at_breaks(self.plain, shown + text.replace("\n", f"\n\u010a\n{shown}"), len(part))
                table.update(zip(part, got if got is not None else [self._encode(lead + w) for w in part]))
            new = hard
        if new:
            got = self._split_at_breaks(self.tokenizer, "\n".join([lead + w for w in new]), len(new))
            table.update(zip(new, got if got is not None else [self._encode(lead + w) for w in new]))

    def _learn(self, missing: set[str]) -> None:
        """Ids of pieces not yet known, from those of whole words and of the marks that
        end them; a piece with blanks inside is encoded on its own."""
        missing.discard("")
        self.pieces[""] = self._encode(" ")
        self.words[""] = b""
        broken = [p[1:] for p in missing if p[0] == "\n"]
        plain = [p for p in missing if p[0] != "\n"]
        for bodies, lead, ids in ((plain, " ", b""), (broken, "", self.lone)):
            if ids is None or _BLANK.search("\0".join(bodies)):
                own = [b for b in bodies if ids is None or _BLANK.search(b)]
                self.pieces.update((b if lead else "\n" + b, self._encode((lead or "\n") + b)) for b in own)
                bodies = [] if ids is None else [b for b in bodies if not _BLANK.search(b)]
            table = self.pieces if lead else self.words  # words after a blank are pieces themselves
            whole = [b for b in bodies if b[-1:] not in _ENDS]
            ended = [(s, b[len(s):], b) for b in bodies if b[-1:] in _ENDS and ((s := b.rstrip(ENDINGS))[-1:].isalnum() or whole.append(b))]
            new = dict.fromkeys(whole)
            new.update(dict.fromkeys([s for s, _, _ in ended]))
            self._learn_words(table, [w for w in new if w not in table], lead)
            self._learn_words(self.words, [m for m in {m for _, m, _ in ended} if m not in self.words], "")
            if lead:
                self.pieces.update([(b, table[s] + self.words[m]) for s, m, b in ended])
            else:
                self.pieces.update([("\n" + b, ids + table[b]) for b in whole])
                self.pieces.update([("\n" + b, ids + table[s] + self.words[m]) for s, m, b in ended])

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        self.pieces, self.words = _bounded(self.pieces, PIECES_KEPT), _bounded(self.words, WORDS_KEPT)
        cut = [self._cut(t or "") for t in texts]
        firsts = [self._encode(c.pop(0)) for c in cut]
        known = [list(map(self.pieces.get, c)) for c in cut]
        gaps = [[i for i, x in enumerate(k) if x is None] if None in k else [] for k in known]
        self._learn({c[i] for c, gap in zip(cut, gaps) for i in gap})
        for c, k, gap in zip(cut, known, gaps):
            for i in gap:
                k[i] = self.pieces[c[i]]
        return [np.frombuffer(first + b"".join(k), self.width) for first, k in zip(firsts, known)]


def _bounded(table: dict[str, bytes], most: int) -> dict[str, bytes]:
    """``table``, or its older half if it is larger than ``most``: frequent words come early."""
    return table if len(table) <= most else dict(islice(table.items(), most // 2))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file, until another operator's tasks come."""
    hold("tokens", _encoder.cache_clear)
    return _encoder(path)


def end_of(ids: np.ndarray) -> np.ndarray:
    """The ids of a document: its text's ids and the end id."""
    return np.append(ids, np.array([END_ID], ids.dtype))
