"""Test helper: write a zip whose members use the classic PKWARE stream
cipher (the one the standard library can read), stored, no compression."""

import struct
import zlib

_TABLE = []
for _n in range(256):
    _c = _n
    for _ in range(8):
        _c = (_c >> 1) ^ 0xEDB88320 if _c & 1 else _c >> 1
    _TABLE.append(_c)


def _crc_byte(crc: int, b: int) -> int:
    return (crc >> 8) ^ _TABLE[(crc ^ b) & 0xFF]


class _Cipher:
    def __init__(self, password: bytes):
        self.k = [0x12345678, 0x23456789, 0x34567890]
        for b in password:
            self._update(b)

    def _update(self, b: int) -> None:
        k0, k1, k2 = self.k
        k0 = _crc_byte(k0, b)
        k1 = ((k1 + (k0 & 0xFF)) * 134775813 + 1) & 0xFFFFFFFF
        k2 = _crc_byte(k2, (k1 >> 24) & 0xFF)
        self.k = [k0, k1, k2]

    def encrypt(self, data: bytes) -> bytes:
        out = bytearray()
        for p in data:
            t = (self.k[2] | 2) & 0xFFFF
            out.append(p ^ (((t * (t ^ 1)) >> 8) & 0xFF))
            self._update(p)
        return bytes(out)


def encrypted_zip(members, password: str) -> bytes:
    body, central = bytearray(), bytearray()
    for name, data in members:
        crc = zlib.crc32(data) & 0xFFFFFFFF
        header = bytes(range(11)) + bytes([crc >> 24])
        enc = _Cipher(password.encode()).encrypt(header + data)
        fname = name.encode()
        offset = len(body)
        body += struct.pack("<IHHHHHIIIHH", 0x04034B50, 20, 1, 0, 0, 0, crc, len(enc), len(data), len(fname), 0) + fname + enc
        central += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 20, 20, 1, 0, 0, 0, crc, len(enc), len(data), len(fname), 0, 0, 0, 0, 0, offset) + fname
    n = len(members)
    eocd = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, len(central), len(body), 0)
    return bytes(body + central + eocd)
