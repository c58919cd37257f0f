"""Token counters of public vocabularies, made once a Python worker from a file that all executors have."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import groupby
from typing import Any

CAPTION_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
ENDS = 2  # the tokens before and after a caption
KEPT, LONGEST = 1 << 19, 64  # counts that a cache holds at most, and the longest key that it keeps

# The rules of vocabularies whose texts may be counted word by word.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def ranges(kinds: str) -> str:
    """Inside of a pattern's set: characters of these general categories, the same since Unicode 3.2, that lower-case one by one to such.

    Text of these is composed, split and lower-cased alike by all later versions. Capital sigma is left out, which Python lower-cases by its place.
    """

    def is_one(c: str) -> bool:
        kind = unicodedata.category(c)
        return kind.startswith(tuple(kinds.split())) and kind == unicodedata.ucd_3_2_0.category(c) and c != "Σ"

    codes = [i for i in range(33, 0x10000) if is_one(chr(i)) and len(low := chr(i).lower()) == 1 and is_one(low)]
    runs = [list(run) for _, run in groupby(enumerate(codes), lambda at: at[1] - at[0])]
    return "".join(f"{re.escape(chr(run[0][1]))}-{re.escape(chr(run[-1][1]))}" for run in runs)


LETTERS, NUMBERS, MARKS = ranges("L"), ranges("N"), ranges("M P S Cf")
PLAIN = re.compile(f"[{LETTERS}{NUMBERS}{MARKS}]*")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}  # the other bytes stand for themselves


class Counts(dict):
    """Key -> count, made when first asked for. Short keys are kept; a full cache starts anew."""

    def __init__(self, count: Callable[[Any], int]) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, key: Any) -> int:
        n = self.count(key)
        if len(key) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[key] = n
        return n


@lru_cache(maxsize=1)
def counter(path: str) -> Callable[[str], int]:
    """Counts words between ASCII white space, which no token, composition or match of the split crosses; each word's count is made once.

    Composed words of plain characters are lower-cased and split here, their pieces counted by the vocabulary's model; the tokenizer itself
    counts all other words, and whole texts if the vocabulary has other rules.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        content = f.read()
    rules, tokenizer = json.loads(content), Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.encode_special_tokens = True

    def encoded(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    by_words = (
        rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTE_LEVEL]}
        and rules["model"]["type"] == "BPE" and not rules["model"]["dropout"] and all(t["special"] for t in rules["added_tokens"])
    )
    if not by_words:
        return encoded
    model = tokenizer.model

    def count_piece(piece: str) -> int:
        return len(model.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTES)))

    pieces = Counts(count_piece)

    def count_word(word: bytes) -> int:
        text = word.decode()
        plain = PLAIN.fullmatch(text) and unicodedata.is_normalized("NFC", text)
        return sum(map(pieces.__getitem__, PIECES.findall(text.lower()))) if plain else encoded(text)

    words = Counts(count_word)
    return lambda text: sum(map(words.__getitem__, text.encode().split()))  # bytes split at ASCII white space alone


def caption_tokens(path: str = CAPTION_VOCABULARY) -> Callable[[], Callable[[str], int]]:
    """Maker of the function caption -> tokens, its start and end included, not truncated; special tokens' strings in it are text."""

    def make() -> Callable[[str], int]:
        count = counter(path)
        return lambda text: count(text) + ENDS

    return make
