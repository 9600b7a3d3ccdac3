"""Text clean-up and byte-level tokenization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special token ids, the offset of the 256 byte pieces and the largest id a token shard may hold.
UNK_ID = 0
BOS_ID = 1
EOS_ID = 2
PAD_ID = 0
BYTE_OFFSET = 3
MAX_TOKEN_ID = 65535

# Unicode white space plus the four ASCII separators that Python's str.strip also removes.
_OUTER_SPACE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
_SPACE = r"(?U)[\s\x1c-\x1f]"


def strip_text(text: Column) -> Column:
    """Remove leading and trailing white space the way Python's ``str.strip`` does.

    The whole text goes through the regular expression only if its first or last character is white space.
    """
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(F.rlike(ends, F.lit(_SPACE)), F.regexp_replace(text, _OUTER_SPACE, "")).otherwise(text)


def byte_tokenize(text: Column) -> Column:
    """UTF-8 byte ``b`` becomes token ``b + 3``.

    The bytes are viewed as a Latin-1 string, in which every byte is one character, so that splitting and reading the
    code point need no per-byte regular expression or hexadecimal conversion.
    """
    one_char_per_byte = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    ids = F.transform(F.split(one_char_per_byte, ""), lambda c: F.ascii(c) + F.lit(BYTE_OFFSET))
    return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(ids)


def byte_length(text: Column) -> Column:
    """Number of tokens ``byte_tokenize`` yields, without building them."""
    return F.octet_length(text)


def add_bos_eos(ids: Column, bos: bool = True, eos: bool = False) -> Column:
    """Put the begin token in front and the end token behind."""
    parts = [ids]
    if bos:
        parts.insert(0, F.array(F.lit(BOS_ID)))
    if eos:
        parts.append(F.array(F.lit(EOS_ID)))
    return F.concat(*parts) if len(parts) > 1 else ids


def out_of_range(ids: Column) -> Column:
    """True when an id does not fit the unsigned 16-bit token format."""
    return F.coalesce((F.array_min(ids) < 0) | (F.array_max(ids) > MAX_TOKEN_ID), F.lit(False))


def count_token(ids: Column, token: int) -> Column:
    """How often ``token`` occurs in ``ids``."""
    return F.size(F.filter(ids, lambda i: i == token))
