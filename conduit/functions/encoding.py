"""Base64, digests and AES."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BLOCK = 16


def _binary(value: Column) -> Column:
    return value.cast("binary")


def base64_encode(value: Column) -> Column:
    """Standard base64 on a single line, whatever the session says on chunking."""
    encoded = F.base64(_binary(value))
    session = SparkSession.getActiveSession()
    single = session and session.conf.get("spark.sql.chunkBase64String.enabled", "true") == "false"
    return encoded if single else F.translate(encoded, "\r\n", "")


def base64_decode(text: Column) -> Column:
    """Decode the leading run of alphabet characters.

    Decoding stops at the first other character, ``=`` included; a single
    left-over character carries less than a byte and is dropped.
    """
    run = F.regexp_extract(text, r"\A[A-Za-z0-9+/]*", 0)
    size = F.length(run)
    whole = F.when(size % 4 == 1, F.substring(run, F.lit(1), size - 1)).otherwise(run)
    return F.unbase64(F.rpad(whole, F.ceil(F.length(whole) / 4).cast("int") * 4, "="))


def md5_hex(value: Column) -> Column:
    """32 lower-case hex digits."""
    return F.md5(_binary(value))


def fingerprint(value: Column, algorithm: str = "md5") -> Column:
    """Digest as colon-separated lower-case hex pairs."""
    digests = {"md5": F.md5, "sha1": F.sha1}
    if algorithm not in digests:
        raise ValueError(f"unknown digest: {algorithm}")
    return F.regexp_replace(digests[algorithm](_binary(value)), "(..)(?!$)", "$1:")


def _zero_padded(value: Column, size: Column) -> Column:
    return F.concat(value, F.substring(F.lit(bytes(BLOCK)), F.lit(1), size - F.octet_length(value)))


def _key(key: Column) -> Column:
    """A key of 16 bytes; any other, and none at all, is an error."""
    key = _binary(key)
    good = F.coalesce(F.octet_length(key) == BLOCK, F.lit(False))
    return F.when(good, key).otherwise(F.raise_error(F.lit("the key must have 16 bytes")).cast("binary"))


def aes_block_encrypt(block: Column, key: Column) -> Column:
    """AES-ECB of one 16-byte block, no padding."""
    padded = F.aes_encrypt(_binary(block), _key(key), F.lit("ECB"), F.lit("PKCS"))
    return F.substring(padded, 1, BLOCK)


def aes_block_decrypt(block: Column, key: Column) -> Column:
    """Inverse of :func:`aes_block_encrypt`."""
    key = _key(key)
    # The cipher wants a padding block at the end: encrypting nothing yields one.
    tail = F.aes_encrypt(F.lit(b""), key, F.lit("ECB"), F.lit("PKCS"))
    return F.aes_decrypt(F.concat(_binary(block), tail), key, F.lit("ECB"), F.lit("PKCS"))


def aes_cbc_encrypt(value: Column, key: Column, iv: Column) -> Column:
    """AES-CBC with the last partial block filled with zero bytes."""
    value, key, iv = _binary(value), _key(key), _binary(iv)
    size = (F.ceil(F.octet_length(value) / BLOCK) * BLOCK).cast("int")
    sealed = F.aes_encrypt(
        _zero_padded(value, size), key, F.lit("CBC"), F.lit("PKCS"), iv
    )
    # the result leads with the vector and ends with the padding block
    return F.substring(sealed, F.lit(BLOCK + 1), size)


def aes_cbc_decrypt(sealed: Column, key: Column, iv: Column, length: Column) -> Column:
    """Inverse of :func:`aes_cbc_encrypt`; needs the original length in bytes."""
    sealed, key, iv = _binary(sealed), _key(key), _binary(iv)
    size = F.octet_length(sealed)
    last = F.when(size > 0, F.substring(sealed, size - BLOCK + 1, F.lit(BLOCK))).otherwise(iv)
    padding = F.substring(
        F.aes_encrypt(F.lit(b""), key, F.lit("CBC"), F.lit("PKCS"), last),
        BLOCK + 1,
        BLOCK,
    )
    opened = F.aes_decrypt(
        F.concat(iv, sealed, padding), key, F.lit("CBC"), F.lit("PKCS")
    )
    return F.substring(opened, F.lit(1), length.cast("int"))
