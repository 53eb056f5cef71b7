"""Token ids of texts from a public vocabulary file, kept per piece of text."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import regex

from etlkit.llm.worker_tables import worker_table

# Kept per Python worker, about 200 bytes each: text between spaces, as many again that grow old, and
# the parts that the vocabulary's pattern cuts it into, a table that is emptied when full.
KEPT_PIECES = 600_000
KEPT_PARTS = 250_000
# Parts handed to the library as one text.
BATCH = 256
# Characters below are letters or not in any version of Unicode.
_SETTLED = "\u0250"


def _is_word(piece: str) -> bool:
    """Letters only, which no pattern cuts."""
    return piece.isalpha() and (piece.isascii() or max(piece) < _SETTLED)


class _Kept(dict):
    """Ids of pieces, which notes those that are asked for and not there.

    When it is full its entries become old; an old one that is asked for is new again, and the
    others go when it is full the next time.
    """

    def __init__(self):
        self.missing: set[str] = set()
        self.old: dict[str, bytes | bool] = {}

    def __missing__(self, piece: str) -> bytes | bool | None:
        found = self.old.get(piece)
        if found is None:
            self.missing.add(piece)
        else:
            self[piece] = found
        return found

    def grow_old(self) -> None:
        self.old = dict(self)
        self.clear()


class TextEncoder:
    """Ids as the ``tokenizers`` library gives them, without special tokens around the text.

    A byte-level vocabulary cuts a text before every space that stands between two other
    characters, so what lies between two such spaces has the same ids in every text. It is
    cut by the vocabulary's pattern, and the library is asked once for each part. A text with
    white space in other places, or with the string of a special token, goes to the library
    as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.vocabulary = 1 + max(chain(parts["model"]["vocab"].values(),
                                        (t["id"] for t in parts["added_tokens"])))
        self.dtype = np.dtype("<u2") if self.vocabulary <= 1 << 16 else np.dtype("<u4")
        self.special = [t["content"] for t in parts["added_tokens"]]
        cut = parts["pre_tokenizer"] or {}
        self.by_piece = (parts["normalizer"] is None and parts["post_processor"] is None
                         and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                         and not cut.get("add_prefix_space"))
        self.kept: dict[str, bytes | bool] = _Kept()
        self.parts: dict[str, bytes] = {}
        if self.by_piece:
            # The same merges on text in the byte alphabet, cut only where a line ends.
            alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
            shown = [c for c in alphabet if ord(c) < 256]
            rest = iter(c for c in alphabet if ord(c) >= 256)
            self.bytes_to_text = {b: chr(b) if chr(b) in shown else next(rest) for b in range(256)}
            self.end = self.bytes_to_text[10]
            self.end_id = parts["model"]["vocab"][self.end]
            self.merges = Tokenizer.from_file(path)
            self.merges.pre_tokenizer = pre_tokenizers.Split(self.end, "isolated")
            self.cut = regex.compile(public_tokenizers.PATTERN).findall
            self.points = dict(zip(".,", self.whole([".", ","])))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.dtype).tobytes() for f in found]

    def _of_lines(self, lines: list[str]) -> Iterator[bytes]:
        """Ids of texts without line ends; many go to the library as the lines of one text."""
        width = self.dtype.itemsize
        for start in range(0, len(lines), BATCH):
            part = lines[start:start + BATCH]
            text = "\n".join(part).encode().decode("latin-1").translate(self.bytes_to_text)
            ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends, data = np.flatnonzero(ids == self.end_id), ids.tobytes()
            if len(ends) != len(part) - 1:
                raise ValueError(f"{len(ends) + 1} lines came back of {len(part)}")
            begins, ends = width * np.r_[0, ends + 1], width * np.r_[ends, len(ids)]
            yield from [data[b:e] for b, e in zip(begins.tolist(), ends.tolist())]

    def _learn_parts(self, parts: list[str]) -> None:
        """Keep the ids of parts."""
        if len(self.parts) + len(parts) > KEPT_PARTS:
            self.parts.clear()
        lines = [p for p in parts if "\n" not in p]
        others = [p for p in parts if "\n" in p]
        self.parts.update(zip(others, self.whole(others), strict=True))
        self.parts.update(zip(lines, self._of_lines(lines), strict=True))

    def _learn(self, pieces: set[str]) -> None:
        """Keep the ids of pieces; False for those whose ids depend on what is next to them."""
        words, ended, others = set(), [], []
        for piece in pieces:
            if _is_word(piece):
                words.add(piece)
            elif piece[-1:] in self.points and _is_word(piece[:-1]):
                ended.append(piece)
            else:
                others.append(piece)
        words.update([w for p in ended if (w := p[:-1]) not in self.kept])
        new = list(words)
        self.kept.update(zip(new, self._of_lines([" " + w for w in new]), strict=True))
        for piece in ended:
            self.kept[piece] = self.kept[piece[:-1]] + self.points[piece[-1]]
        self._learn_others(others)

    def _learn_others(self, pieces: list[str]) -> None:
        cut, alone = {}, []
        for piece in pieces:
            bare, text = (piece[1:], piece[1:]) if piece[:1] == " " else (piece, " " + piece)
            if not bare or bare[0].isspace() or bare[-1].isspace():
                self.kept[piece] = False
            elif not bare.isascii() and max(bare) >= _SETTLED:
                alone.append((piece, text))
            elif bare.isalpha():
                cut[piece] = text,
            elif bare[-1] in ".," and bare[:-1].isalpha():
                cut[piece] = text[:-1], bare[-1]
            else:
                cut[piece] = self.cut(text)
        new = {part for parts in cut.values() for part in parts if part not in self.parts}
        if len(self.parts) + len(new) > KEPT_PARTS:
            new = set(chain.from_iterable(cut.values()))
        self._learn_parts(list(new))
        known = self.parts.__getitem__
        for piece, parts in cut.items():
            self.kept[piece] = known(parts[0]) if len(parts) == 1 else b"".join(map(known, parts))
        self.kept.update(zip([p for p, _ in alone], self.whole([t for _, t in alone]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of ``dtype``."""
        if not self.by_piece:
            return self.whole(texts)
        cut = []
        for text in texts:
            pieces = text.split(" ")
            pieces[0] = " " + pieces[0]  # holds a space, as no other does: a text's first piece
            cut.append(pieces)
        get, missing = self.kept.__getitem__, self.kept.missing
        found, lacking = [], []
        for pieces in cut:
            found.append(list(map(get, pieces)))
            lacking.append(bool(missing))
        if missing:
            # Words are kept with and without the point that follows them.
            if len(self.kept) + 2 * len(missing) > KEPT_PIECES:
                self.kept.grow_old()
            self._learn(missing)
            missing.clear()
        out = []
        for text, pieces, ids, some in zip(texts, cut, found, lacking):
            if any(s in text for s in self.special):
                out.append(self.whole([text])[0])
                continue
            if some:
                ids = [get(piece) if i is None else i for piece, i in zip(pieces, ids)]
            try:
                out.append(b"".join(ids))
            except TypeError:  # a piece is False
                out.append(self.whole([text])[0])
        return out


def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker."""
    return worker_table(f"bytes:{path}", lambda: TextEncoder(path))
