"""Texts for the tests of the training-data operators."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards boil green soup beside cold rivers".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 16 & 15] + ("" if x >> 20 & 3 else str(x >> 24)))
    return " ".join(out)


LONG = sentence(99, 30_000)
TEXTS = [
    None, "", " ", " \t\n\x0b\x0c\r ", "one", "Two words", "three  small\twords", "a b c d", "a b c d e",
    "\\### Assistant: </turn> ok <turn>\\o\\n", "café ÜBER été, naïve; 中文 \U0001f600   　x\u0085y",
    "it's we'll  they're \n\n  done!! <|endoftext|> <s> ▁ <unk>", "x" * 3000, "\U0001f600" * 500, "# * $ % & | < >" * 9,
    "line one\nline one\nline two\n\nline one", "same words again and again here now " * 12, LONG,
    *(sentence(i, 40 + i) for i in range(30)), *(sentence(i, 60) + " tail" for i in (1, 1, 1, 2, 2)),
]
