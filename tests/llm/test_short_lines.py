"""Short lines one edit apart are repeats too."""

import random

from breezemart.llm.line_dedup import line_repeats


def alike(a, b):
    """At most one code point inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    return a == b or any(a[:i] + a[i + 1:] == (b if len(b) < len(a) else b[:i] + b[i + 1:]) for i in range(len(a)))


def test_short_lines_against_all_pairs(spark):
    rng = random.Random(20)
    pairs = ["With, to to.", "With to to.", "The thertion.", "The, thertion.", "Heti eror anesti.", "Heti, eror anesti.", "x", "yz", "\t"]
    docs = [(i, "\n".join("".join(rng.choice("abcdefé ") for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 19, 20])))
                          for _ in range(rng.randint(0, 5)))) for i in range(50)]
    docs += [(100 + i, line) for i, line in enumerate(pairs)]
    seen, want = [], {}
    for i, text in docs:
        want[i] = []
        for k, line in enumerate(text.split("\n")):
            if line.strip(" "):
                if any(alike(line, other) for other in seen):
                    want[i].append(str(k))
                seen.append(line)
    found = line_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.dropped_lines for r in found} == {i: ",".join(k) for i, k in want.items()}
    assert want[101] == want[103] == want[105] == ["0"]
