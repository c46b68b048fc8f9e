"""Made-up sentences and the folder of the smallest tables."""

SF = "/root/testdata/sf0.001"

WORDS = "the quick brown fox jumps over a lazy dog while seven grey geese watch from behind the old stone wall".split()


def sentence(start, n):
    return " ".join(WORDS[(start * 7 + k * (start % 5 + 1)) % len(WORDS)] + str(start % 3) * (k % 4 == 0) for k in range(n))
