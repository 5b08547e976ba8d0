"""Tokenizing with a public tokenizers file, one load per worker and a bounded memo of words.

``TextEncoder`` returns exactly what ``Tokenizer.encode(text, add_special_tokens=False)`` gives for a byte-level BPE
file. Its split never joins characters over the start of a space that follows a non-space, over a line
break, or from a letter or digit to the punctuation after it. So a text is cut there, and each
piece is encoded once per worker; texts that hold a space next to other white space, longer runs of line breaks,
rare kinds of white space, or an added token are encoded whole.
"""

from __future__ import annotations

from array import array

import numpy as np

from .common import worker_cache

MEMO_WORDS = 500_000  # bound of the memo in each Python worker (about 110 MB)
CHUNK = 4_000_000  # characters whose distinct pieces are looked up together (some 60 MB of words and ids)

MARK = "\x01"  # starts a piece that no space precedes
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Byte-level files spell each byte as one character: bytes without a printable Latin-1 character follow U+0100 in order.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(_UNPRINTED)}
SPACE = chr(BYTE_CHARS[32])


def default_path() -> str:
    """The byte-level BPE file among the public tokenizers of the environment."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_tokenizer(path: str, plain: bool = False):
    """The worker's tokenizer of ``path``. ``plain``: another object that encodes special strings of a text as ordinary text;
    neither is to be changed by its users."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
    from tokenizers import Tokenizer

    held = worker_cache("tokenizers")
    if (path, plain) not in held:
        tok = Tokenizer.from_file(path)
        if plain:
            tok.encode_special_tokens = True
        held[path, plain] = tok
    return held[path, plain]


class TextEncoder:
    """Encodes batches of texts to little-endian uint16 or uint32 ids (by vocabulary size)."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        import json
        import re

        self.tok = load_tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo = worker_cache("memo " + path)
        self.bound = memo_words
        self.spill = worker_cache("spill " + path)
        after = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
        self.marks = [(c, re.compile(rf"{re.escape(c)}(?<=[{after}].)(?=[ \n]|\Z)"), f" {MARK}{c}") for c in ".,;:!?"]
        spec = worker_cache("spec")
        if path not in spec:
            with open(path, encoding="utf-8") as f:
                j = json.load(f)
            pre = j.get("pre_tokenizer") or {}
            spec[path] = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                          and j.get("normalizer") is None, [t["content"] for t in j.get("added_tokens", [])])
        self.cuttable, self.added = spec[path]
        # texts encoded whole (RE2); the brackets hold white space besides space and line feed
        self.odd = "|".join([f"  | \n|\n |\n\n\n|\n\n\\z|{MARK}", *map(re.escape, self.added),
                             "[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"])
        self.line = np.frombuffer(self._whole(["\n"])[0], self.dtype)
        self._start()

    def _start(self) -> None:
        """Pieces that cannot be joined to others for encoding."""
        self.memo.update({MARK: b"", MARK + "\n": self.line.tobytes(), "": self._whole([" "])[0]})

    def _whole(self, texts):
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        import gc

        texts = [t or "" for t in texts]
        if not self.cuttable:
            return self._whole(texts)
        out, at = [], 0
        while at < len(texts):  # some million characters at a time
            end, size = at, 0
            while end < len(texts) and (end == at or size < CHUNK):
                size += len(texts[end])
                end += 1
            collecting = gc.isenabled()
            gc.disable()  # only strings and bytes are made here, nothing for the collector
            try:
                out += self._some(texts[at:end])
            finally:
                if collecting:
                    gc.enable()
            at = end
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        import pyarrow as pa
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), self.odd).to_pylist()
        out, places, cut, whole = [b""] * len(texts), [], [], []
        for i, t in enumerate(texts):
            if odd[i]:
                whole.append(i)
            else:
                for c, pattern, put in self.marks:
                    if c in t:
                        t = pattern.sub(put, t)
                places.append(i)
                cut.append(MARK + t.replace("\n", f" {MARK}\n {MARK}"))
        if cut:
            parts = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
            coded = parts.flatten().dictionary_encode()  # each distinct piece is looked up once
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            joined = pa.array(self._ids(distinct), pa.large_binary()).take(coded.indices)
            _, ends, raw = joined.buffers()
            ends, raw = np.frombuffer(ends, np.int64)[parts.offsets.to_numpy()].tolist(), memoryview(raw or b"")
            for i, start, end in zip(places, ends, ends[1:]):
                out[i] = raw[start:end].tobytes()
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, by the memo; new pieces are learnt."""
        memo, spill = self.memo, self.spill
        ids = list(map(memo.get, pieces))
        holes = [k for k, x in enumerate(ids) if x is None]
        if len(memo) >= self.bound and 2 * len(holes) > len(pieces):
            memo.clear()  # the texts have changed their vocabulary
            self._start()
        missing = [pieces[k] for k in holes]
        found = list(map(spill.get, missing))
        new = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(new, self._learn([missing[k] for k in new])):
            found[k] = x
        for k, x in zip(holes, found):
            ids[k] = x
        room = max(0, self.bound - len(memo))
        memo.update(zip(missing[:room], found))
        if room < len(missing):  # full: words first seen now wait in the smaller dict
            if len(spill) > self.bound // 5:
                spill.clear()
            spill.update(zip(missing[room:], found[room:]))
        return ids

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Encode new pieces. A word of Latin letters goes straight to the tokenizer's model, and so does the punctuation
        that ends it, which the split parts from it; others are encoded many in one call, where a line break between two
        pieces is a token of its own."""
        tokenize, tails, code, rest = self.tok.model.tokenize, {}, "HI"[self.dtype.itemsize // 4], []
        out = [b""] * len(pieces)
        for k, w in enumerate(pieces):
            word = w[1:] if w[0] == MARK else w
            head, tail = word, ""
            if not word.isalpha():
                head = word.rstrip(PUNCTUATION)
                tail = word[len(head):]
            if head.isalpha() and (head.isascii() or max(head) < "\u0250"):
                if not head.isascii():
                    head = head.encode().decode("latin-1").translate(BYTE_CHARS)
                ids = array(code, [t.id for t in tokenize(head if w[0] == MARK else SPACE + head)])
                if tail:
                    if tail not in tails:
                        tails[tail] = array(code, [t.id for t in tokenize(tail)])
                    ids += tails[tail]
                out[k] = ids.tobytes()
            else:
                rest.append(k)
        for a in range(0, len(rest), 10_000):
            part = rest[a:a + 10_000]
            texts = [w[1:] if w[0] == MARK else " " + w for w in (pieces[k] for k in part)]
            ids = np.frombuffer(self._whole(["\n".join(texts)])[0], self.dtype)
            ends = np.flatnonzero(ids == self.line[0])
            if len(self.line) == 1 and len(ends) == len(part) - 1:
                raw, size = ids.tobytes(), self.dtype.itemsize
                lo, hi = [0, *((ends + 1) * size).tolist()], [*(ends * size).tolist(), len(raw)]
                encoded = [raw[i:j] for i, j in zip(lo, hi)]
            else:
                encoded = self._whole(texts)
            for k, x in zip(part, encoded):
                out[k] = x
        return out
