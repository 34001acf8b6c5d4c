"""Made-up sentences for the tests of this folder."""

WORDS = "the of and to in that is was for on as with it by be at from or an are this".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i * 3 + i) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(n))
