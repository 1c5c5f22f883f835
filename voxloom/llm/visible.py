"""What a reader sees of a text: one form for all encodings that look the same."""

from __future__ import annotations

import re
import unicodedata

# Letters drawn like a Latin letter, by script, and the Latin letters they look like.
CYRILLIC = "АВЕКМНОРСТХЅІЈԌԚԜѴҮӀаеорсухѕіјһԁԛԝѵүӏ"
CYRILLIC_AS = "ABEKMHOPCTXSIJGQWVYIaeopcyxsijhdqwvyl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαιονρυϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXCaıovpucj"
ARMENIAN = "ՕՍՏոսհզցօ"
ARMENIAN_AS = "OUSnuhqgo"
CHEROKEE = "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏢᏦᏩᏙᏚᏞᏟᏴ"
CHEROKEE_AS = "DRTAJEWMHYGZPKGVSLCB"
VARIANTS = "ɑɡ"
VARIANTS_AS = "ag"
# Characters without look-alike letters in another script that are drawn the same.
SAME_SIGN = {"‐": "-", "‑": "-", "Ð": "Đ", "Ɖ": "Đ", "ʼ": "’"}
# Invisible characters that the category Cf doesn't hold.
INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
# Kinds of compatibility mapping that leave the look of a character unchanged but for its width.
SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<isolated>", "<initial>", "<medial>", "<final>"}

# Characters that a reader tells apart from what the compatibility mapping makes of them.
OTHER_LOOK = set("ſϐϑϒϕϖϰϱϲϴϵϹ")

LOOKS_LIKE = {
    **dict(zip(CYRILLIC, CYRILLIC_AS, strict=True)), **dict(zip(GREEK, GREEK_AS, strict=True)), **dict(zip(ARMENIAN, ARMENIAN_AS, strict=True)),
    **dict(zip(CHEROKEE, CHEROKEE_AS, strict=True)), **dict(zip(VARIANTS, VARIANTS_AS, strict=True)),
}

# Marks of Thai and of Lao in the order in which they are stacked on a consonant.
_STACK = {
    **dict.fromkeys(map(chr, [0x0E38, 0x0E39, 0x0E3A, 0x0EB8, 0x0EB9, 0x0EBA, 0x0EBC]), 0),
    **dict.fromkeys(map(chr, [0x0E31, 0x0E34, 0x0E35, 0x0E36, 0x0E37, 0x0E47, 0x0EB1, 0x0EB4, 0x0EB5, 0x0EB6, 0x0EB7, 0x0EBB]), 1),
    **dict.fromkeys(map(chr, [0x0E4D, 0x0ECD]), 2),
    **dict.fromkeys(map(chr, [0x0E48, 0x0E49, 0x0E4A, 0x0E4B, 0x0EC8, 0x0EC9, 0x0ECA, 0x0ECB]), 3),
    **dict.fromkeys(map(chr, [0x0E4C, 0x0E4E, 0x0ECC]), 4),
}
_MARKS = "".join(_STACK)
_RUN = re.compile(f"[{_MARKS}]{{2,}}")
_LEVEL = ["".join(c for c, at in _STACK.items() if at == level) for level in range(5)]
_DISORDER = re.compile("|".join(f"[{_LEVEL[k]}][{''.join(_LEVEL[:k])}]" for k in range(1, 5)))
# Characters that stand for themselves, so that most texts need no mapping at all.
_TO_MAP = re.compile("[^ -~²³¹’À-ÏÑ-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ɏḀ-ẙẛ-ỿ\u0e01-\u0e5b\u0e81-\u0edb\u4e00-\u9fff。、]|[Ɖ]")
_AM = re.compile("ํ([่-๋]?)า|ໍ([່-໋]?)າ")
_SPACE = re.compile(" {2,}| ?\n ?")


def _one(char: str) -> str:
    """The visible parts of one character, decomposed."""
    point = ord(char)
    kind = unicodedata.category(char)
    if char in "\n\u2028\u2029\x0b\x0c\x85":
        return "\n"
    if kind == "Zs" or char == "\t":
        return " "
    if kind in ("Cf", "Cc") or point in INVISIBLE:
        return ""
    mapping = unicodedata.decomposition(char).split(" ")
    if char in "ำຳ":  # composed again below, so never taken apart
        return char
    if mapping[0] in SAME_LOOK and mapping[1] != "0020" and char not in OTHER_LOOK:
        return "".join(_one(chr(int(x, 16))) for x in mapping[1:])
    return "".join(SAME_SIGN.get(c, c) for c in unicodedata.normalize("NFD", char))


class _Table(dict):
    """Visible parts by code point, look-alike letters in their own script or in Latin."""

    def __init__(self, latin: bool) -> None:
        super().__init__()
        self.latin = latin

    def __missing__(self, point: int) -> str:
        parts = _one(chr(point))
        value = self[point] = "".join(LOOKS_LIKE.get(c, c) for c in parts) if self.latin else parts
        return value


_SKELETON, _VISIBLE = _Table(True), _Table(False)


def skeleton(text: str) -> str:
    """The one form of all strings that look like ``text``, with every look-alike letter in Latin."""
    return _even(text, _SKELETON)


def visible(text: str) -> str:
    """The text with what can't be seen evened out, every letter in the script in which it is written.

    Width, spaces' kind, ignorable characters, composition and the typed order of stacked marks
    are evened out; case, accents, tone marks, raised digits and native numerals stay. Runs of
    spaces and spaces at the ends count as one and none.
    """
    return _even(text, _VISIBLE)


def _even(text: str, table: _Table) -> str:
    t = text
    if _TO_MAP.search(t):
        t = unicodedata.normalize("NFC", t.replace("\r\n", "\n").translate(table))
    t = t.replace("เเ", "แ").replace("ເເ", "ແ")
    if _DISORDER.search(t):
        t = _RUN.sub(lambda m: "".join(sorted(m[0], key=_STACK.__getitem__)), t)
    if "ํ" in t or "ໍ" in t:
        t = _AM.sub(lambda m: f"{m[1]}ำ" if m[1] is not None else f"{m[2]}ຳ", t)
    if "  " in t or "\n" in t:
        t = _SPACE.sub(lambda m: "\n" if "\n" in m[0] else " ", t)
    return t.strip(" \n")
