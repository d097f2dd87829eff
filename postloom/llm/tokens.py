"""Token ids of whole texts by a byte-level BPE vocabulary."""

from __future__ import annotations

import base64

VOCABULARY = "byte_bpe_50k.tiktoken"

# The added token of ``byte_bpe_50k.json``, which is not among the ranks.
SPECIAL = {"<|endoftext|>": 50256}


def encoding(path: str | None = None):
    """Encoder over the rank file, which has the same vocabulary and merges as ``byte_bpe_50k.json``.

    It is built once per worker process; ``ids`` gives the ids that the tokenizers library gives (a test compares them), in
    less time.
    """
    import public_tokenizers
    import tiktoken
    from tiktoken import registry

    path = path or public_tokenizers.path(VOCABULARY)
    known = registry.ENCODINGS.get(path)
    if known is None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        known = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        registry.ENCODINGS[path] = known
    return known


def ids(encoder, text: str):
    """Ids of ``text`` as an array; the text of an added token is that token, as in the tokenizers library."""
    return encoder.encode_to_numpy(text, allowed_special="all", disallowed_special=())
