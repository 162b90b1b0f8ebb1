"""Public tokenizers inside tasks, loaded once per worker from a given path."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: A single space between word characters. No token of the vocabularies here reaches over it.
_SAFE = re.compile(r"(?<=\w) (?=\w)")
#: White space in a row that the faster library's matcher runs out of stack on, some way before it does.
_BLANK_RUN = re.compile(r"\s{50000}")
#: How byte-level vocabularies write words apart (fixed value of the public format).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_parts(text: str, limit: int) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, each but the first beginning with the space it was cut at."""
    here = 0
    while len(text) - here > limit:
        cut = _SAFE.search(text, here + limit)
        if cut is None:
            break
        yield text[here : cut.start()]
        here = cut.start()
    yield text[here:]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _own_library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """A function from text to ids equal to those of the byte-level vocabulary at ``path``.

    Ids of such a vocabulary are in the order of its merges, so the faster library
    can use them as ranks. Special strings inside a text become their own ids. A part with a very long run of
    white space goes to the vocabulary's own library, as the other cannot match it.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in stated["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in stated["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)

    def of_part(part: str) -> np.ndarray:
        if _BLANK_RUN.search(part):
            return np.array(_own_library(path).encode(part, add_special_tokens=False).ids, np.uint32)
        return encoding.encode_to_numpy(part, allowed_special=allowed)

    def ids(text: str) -> np.ndarray:
        parts = [of_part(p) for p in safe_parts(text, 1 << 20)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    return ids


@lru_cache(maxsize=2)
def sentence_pieces(path: str):
    """The model at ``path``, and whether none of its pieces reaches over a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return model, not any("▁" in piece.lstrip("▁") for piece in pieces)
