"""Token counts with a whole-token shortcut."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from odsflow.llm.common import named, remembered

#: Letters that are known without asking the library; characters beyond these and printable ASCII are classed by it, once each.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[\t\n\r -~{LETTERS}]*")
#: The published pre-token pattern of byte-level BPE, for texts of those characters (fixed value).
PRE_TOKENS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
#: Results one worker remembers per generation; see `Remembered`.
REMEMBERED = 250_000


class Remembered(dict):
    """Results of `work`, by its argument, of at most twice `limit` recent arguments.

    When full it becomes the older generation, from which what is asked for again moves up.
    """

    def __init__(self, work, limit: int = REMEMBERED):
        super().__init__()
        self.work, self.limit, self.older = work, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@remembered(4)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary on this machine: a path as it is, else a name among the public ones."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Classes(dict):
    """For `str.translate`: a known character of the same class for every character, found by asking the library's pre-tokeniser.

    A letter joins two letters into one pre-token, a digit two digits, another sign two signs; white space joins none of
    them and joins itself. A character of which none of this holds becomes UNKNOWN.
    """

    UNKNOWN = "\ufffe"

    def __init__(self, pieces):
        super().__init__({ord(c): c for c in map(chr, range(0x20, 0x7F))} | {ord(c): c for c in "\t\n\r"})
        self.pieces = pieces

    def __missing__(self, code: int) -> str:
        char, found = chr(code), []
        for known, text in (("a", "a{}a"), ("0", "0{}0"), ("!", "!{}!")):
            if self.pieces(text.format(char)) == 1 and self.pieces(" " + char) == 1:
                found.append(known)
        if not found and all(self.pieces(f"{c}{char}{c}") == 3 for c in "a0!") and self.pieces(char * 2) == 1:
            found.append("\t")
        self[code] = found[0] if len(found) == 1 else self.UNKNOWN
        return self[code]


class TokenCounter:
    """Counts tokens as the library does, for byte-level BPE vocabularies.

    Offline, each vocabulary string that is a text is shown to the model alone; those that come
    back as exactly one token, their own, are whole tokens. A pre-token in that set counts one
    without any merge; only the others are merged, once each while they are remembered. A text of any script is cut into
    pre-tokens by the classes of its characters (see Classes). Only texts with a character without a class, or with the
    text of an added token, are left to the library as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.symbols = {b: s for b, s in byte_symbols().items()}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = frozenset(self._whole_tokens())
        self.merged = Remembered(self._merge)
        self.classes = Classes(lambda text: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(text)))

    def _whole_tokens(self):
        byte_of = {s: b for b, s in self.symbols.items()}
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if all(c in byte_of for c in token):
                try:
                    text = bytes(byte_of[c] for c in token).decode()
                except UnicodeDecodeError:
                    continue
                if [t.id for t in self.tokenizer.model.tokenize(token)] == [number]:
                    yield text

    def _merge(self, pre_token: str) -> int:
        mapped = "".join(self.symbols[b] for b in pre_token.encode())
        return len(self.tokenizer.model.tokenize(mapped))

    def pre_tokens(self, text: str) -> list[str] | None:
        """The pieces that are encoded on their own; None if a character has no class."""
        if PLAIN.fullmatch(text):
            return PRE_TOKENS.findall(text)
        known = text.translate(self.classes)
        if Classes.UNKNOWN in known:
            return None
        return [text[m.start():m.end()] for m in PRE_TOKENS.finditer(known)]

    def count(self, text: str) -> int:
        pre_tokens = None if any(a in text for a in self.added) else self.pre_tokens(text)
        if pre_tokens is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        whole, merged = self.whole, self.merged
        rest = [p for p in pre_tokens if p not in whole]
        return len(pre_tokens) - len(rest) + sum([merged[p] for p in rest])


@remembered(2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_udf(tokenizer: str):
    @F.arrow_udf("long")
    def counts(texts: pa.Array) -> pa.Array:
        count = counter(tokenizer_path(tokenizer)).count
        return pa.array(np.fromiter((count(t.as_py() or "") for t in texts), np.int64, len(texts)))

    return counts


def with_token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """The rows with `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens).

    Whole texts are counted, without begin, end or added special tokens; an added token's text
    inside a text is that token, as by the library's default. A NULL text is the empty text (0, 0,
    false). All other columns stay; columns that already have one of the three names are replaced.
    Nothing is shuffled. `tokenizer` is a file's path, or the name of a public vocabulary.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": count_udf(tokenizer)(text)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
