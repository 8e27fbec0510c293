"""Words of a word-level BPE file: lower case, white space dropped, as the tokenizers library splits them."""

import re
import unicodedata

import regex

# What the vocabulary file's format prescribes.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
PLAIN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))  # shown as themselves


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one above 255."""
    others = iter(range(256, 512))
    return [chr(b) if b in PLAIN_BYTES else chr(next(others)) for b in range(256)]


def unassigned() -> re.Pattern:
    """Characters that this Python's Unicode tables do not know; other tables may have letters or capitals there."""
    ranges, start, end = [], None, 0x110000
    for code in range(end + 1):
        unknown = code < end and unicodedata.category(chr(code)) == "Cn"
        if unknown and start is None:
            start = code
        elif not unknown and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(code - 1))}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class Words:
    """Splits texts into lower-case words. Where two versions of Unicode may differ, the library's own tables decide."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.bytes_of = {c: b for b, c in enumerate(byte_characters())}
        self.ascii_words, self.words = re.compile(ASCII_PATTERN), regex.compile(WORD_PATTERN)
        self.unassigned = unassigned()

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        if self.unassigned.search(text):
            found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
            return [bytes(map(self.bytes_of.__getitem__, word)).decode("utf-8", "replace") for word, _ in found]
        # Lower case is taken character by character: a capital sigma never becomes a final one.
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
