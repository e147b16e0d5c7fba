"""Words of texts: runs of anything but the six ASCII white-space characters."""

from __future__ import annotations

#: ASCII capitals to small letters, all other bytes as they are.
LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def words(body: bytes) -> list[bytes]:
    """Words of a text in UTF-8."""
    return body.split()


def lower_words(body: bytes) -> list[bytes]:
    """Words with A-Z made small."""
    return body.translate(LOWER).split()
