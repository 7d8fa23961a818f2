"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import cached_property, partial

VOCABULARY = "byte_bpe_50k"
RUN = 100_000
LONG_RUN = re.compile(rf"\s{{{RUN}}}")


class Encoder:
    """``ids(text)``: the ids as bytes of little-endian unsigned 32-bit numbers.

    The rank file is the same vocabulary as the JSON file of that name and gives the same ids in less time. With ``added`` the
    strings of the JSON file's added tokens have their one id, as ``tokenizers`` gives it; without, they are ordinary text. A text
    with a run of 100,000 blanks or more, which from about a million exhaust the faster library's stack, is encoded by ``tokenizers``.
    """

    def __init__(self, vocabulary: str = VOCABULARY, added: bool = False):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.stored, self.added = public_tokenizers.path(f"{vocabulary}.json"), added
        tokens = {}
        if added:
            with open(self.stored, encoding="utf-8") as file:
                tokens = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=tokens)
        self.faster = partial(encoding.encode, allowed_special="all") if tokens else encoding.encode_ordinary

    @cached_property
    def complete(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(str(self.stored))
        tokenizer.encode_special_tokens = not self.added
        return tokenizer

    def encode(self, text: str) -> list[int]:
        if len(text) >= RUN and LONG_RUN.search(text):
            return self.complete.encode(text, add_special_tokens=False).ids
        return self.faster(text)

    def ids(self, text: str | None) -> bytes:
        return array("I", self.encode(text or "")).tobytes()

    def count(self, text: str | None) -> int:
        return len(self.encode(text or ""))
