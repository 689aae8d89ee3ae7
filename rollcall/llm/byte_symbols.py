"""The printable character that byte-level vocabularies write for each byte."""


def _symbols() -> list[str]:
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


BYTE_SYMBOLS = _symbols()
