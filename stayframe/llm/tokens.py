"""Token ids of whole texts, with the tokenizer run once per distinct piece.

The public word tokenizer lower-cases, splits a text into pieces (runs of
letters, single digits, runs of other marks) and merges bytes within one
piece only, so the ids of a text are the ids of its pieces one after
another. Each Python worker keeps a bounded memo from piece to ids; only
pieces it has not seen go through the tokenizers library, joined by spaces.
Texts with characters beyond ASCII and Latin-1 letters, or with marks that
could spell a special token, go through the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Bytes of pieces and ids in a worker's memo before it starts afresh (a piece takes some 200 bytes of memory
#: for 15 counted), the same for operators whose tasks hold little else, and the longest piece kept.
MEMO_BYTES, WIDE_MEMO_BYTES, MEMO_CHARS = 4 << 20, 9 << 20, 48

_PLAIN_LETTERS = "a-zß-öø-ÿ"
# letters first, as most pieces are: only the last two kinds can begin alike
_PIECE = re.compile(rf"[{_PLAIN_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t-\r0-9{_PLAIN_LETTERS}]+")
_NOT_PLAIN = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\\|")


class PieceEncoder:
    """encode(text) -> ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work; threads would only spin
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same vocabulary and merges for text that is already split and in lower case
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that close a piece
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {}
        self.held, self.memo_bytes = 0, memo_bytes

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _look_up(self, pieces: list[str]) -> None:
        ids = self._ids(self.pieces, " ".join(pieces))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces) or (len(stops) and stops[-1] != len(ids)):
            raise ValueError("the vocabulary does not close every piece with an end-of-word token")
        raw, at = ids.tobytes(), 0
        for piece, stop in zip(pieces, (stops * 4).tolist()):
            self.memo[piece] = raw[at:stop]
            self.held += len(piece) + stop - at
            at = stop

    def encode(self, text: str) -> bytes:
        if "<|" in text if text.isascii() else _NOT_PLAIN.search(text):
            return self._ids(self.tokenizer, text).tobytes()
        pieces = _PIECE.findall(text.lower())
        memo = self.memo
        if self.held > self.memo_bytes:
            memo.clear()
            self.held = 0
        new = [p for p in set(pieces) if p not in memo]
        if new:
            self._look_up(new)
        out = b"".join(map(memo.__getitem__, pieces))
        for p in new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return out


@lru_cache(maxsize=2)
def piece_encoder(path: str, memo_bytes: int = MEMO_BYTES) -> PieceEncoder:
    """One encoder for each Python worker and vocabulary file."""
    return PieceEncoder(path, memo_bytes)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
