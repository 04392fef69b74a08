"""Fast exact token ids of whole texts, with the ids of words seen before kept
in the worker.

A tokenizer works word by word once a text is cut at white space, so most of
its work is on words it has already seen.  ``WordTokenizer`` and
``ByteTokenizer`` look every white-space-delimited chunk up in a bounded memo and
run the installed tokenizer only on the others; the ids are those of the
tokenizer on the whole text.
"""

from __future__ import annotations

import sys
import types
from array import array

from basketry.llm.common import word_runs

MEMO = 200_000


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across tasks."""
    return vars(sys.modules.setdefault("basketry_worker_cache", types.ModuleType("basketry_worker_cache")))


def word_pattern(spec: dict) -> str | None:
    """The pattern of a tokenizer file that cuts words as ``WordTokenizer`` does;
    None for a file of another kind, whose texts are encoded whole."""
    normal = (spec.get("normalizer") or {}).get("normalizers") or []
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [n.get("type") for n in normal] != ["NFC", "Replace", "Lowercase"] or normal[1].get("pattern") != {"Regex": r"\s+"} or \
            normal[1].get("content") != " " or [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, level = cuts
    if split.get("behavior") != "Removed" or not split.get("invert") or level.get("add_prefix_space") or level.get("use_regex"):
        return None
    return split.get("pattern", {}).get("Regex")


class Memo:
    """What was found last, in two halves: a full new half becomes the old one, so
    frequent entries come over and the rest goes; at most ``2 * MEMO`` entries."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= MEMO:
            self.old, self.new = self.new, {}
        self.new[key] = value


class WordTokenizer:
    """A lower-casing word-end BPE of the ``tokenizers`` library (normalizer NFC,
    white space to one space, lower case; words by a pattern of the file, such as
    letters, single digits, marks; a file of another kind is used on whole texts).  Ids as little-endian 32-bit bytes, without special tokens."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            pattern = word_pattern(json.load(f))
        self.by_word = pattern is not None
        special = [regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special) or r"(?!)").search
        self.cut = regex.compile(pattern or "").findall
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and up
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(other)}
        # ids of chunks and of the words inside them, which are chunks of their own
        self.memo = Memo()

    def word(self, word: str) -> bytes:
        """Ids of one word in lower case."""
        key = word.encode()
        found = self.memo.get(key)
        if found is None:
            spelled = word if word.isascii() else key.decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            self.memo.put(key, found)
        return found

    def chunk(self, chunk: bytes) -> bytes:
        """Ids of one chunk without ASCII white space, that the memo's new half has
        not.  Printable Latin text is in composed form already and lower-cases letter
        by letter; anything else goes through the whole tokenizer."""
        found = self.memo.old.get(chunk)
        if found is None:
            if chunk.isalpha():                             # ASCII letters: one word
                low = chunk.lower()
                found = self.word(low.decode("ascii"))
                if low == chunk:
                    return found
            else:
                text = chunk.decode("utf-8", "replace")
                latin = text.isascii() or max(text) < "ɐ" and "İ" not in text
                if latin and text.isprintable() and not self.special(text):
                    text = text.lower()
                    found = self.word(text) if text.isalpha() else b"".join(map(self.word, self.cut(text)))
                else:
                    found = array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        self.memo.put(chunk, found)
        return found

    def encode(self, text: bytes | None) -> bytes:
        if not self.by_word:
            whole = self.whole.encode((text or b"").decode("utf-8", "replace"), add_special_tokens=False)
            return array("I", whole.ids).tobytes()
        out = []
        for run in word_runs(text or b""):
            get, miss = self.memo.new.get, self.chunk
            out.append(b"".join([get(c) or miss(c) for c in run]))
        return b"".join(out)


class ByteTokenizer:
    """A byte-level BPE of tiktoken from its rank file.  Ids as little-endian
    16-bit bytes (32-bit for larger vocabularies).  A single space before a word
    belongs to the word, so a text without neighbouring white space can be cut
    before its spaces; other texts are encoded whole."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kind = "H" if max(ranks.values(), default=0) < 65_535 else "I"
        self.chunks: dict[str, bytes] = {}

    def chunk(self, chunk: str) -> bytes:
        if len(self.chunks) > MEMO:
            self.chunks.clear()
        found = self.chunks[chunk] = array(self.kind, self.coder.encode_ordinary(" " + chunk)).tobytes()
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        flat = text.replace("\n", " ")
        cut = flat.split(" ")
        if cut != flat.split():                            # neighbouring or other white space, or some at an end
            return array(self.kind, self.coder.encode_ordinary(text)).tobytes()
        get, miss = self.chunks.get, self.chunk
        first, *rest = cut if flat == text else text.split(" ")
        return array(self.kind, self.coder.encode_ordinary(first)).tobytes() + \
            b"".join([get(c) or miss(c) for c in rest])


def word_tokenizer(path: str) -> WordTokenizer:
    cache = worker_cache()
    if ("word", path) not in cache:
        cache["word", path] = WordTokenizer(path)
    return cache["word", path]


def byte_tokenizer(path: str, pattern: str) -> ByteTokenizer:
    cache = worker_cache()
    if ("byte", path) not in cache:
        cache["byte", path] = ByteTokenizer(path, pattern)
    return cache["byte", path]
