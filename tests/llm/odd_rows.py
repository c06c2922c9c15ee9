"""Rows that every operator has to stand, and rows of a frame in a fixed order."""

ODD = [  # nulls, empty and blank texts, ties and repeated rows, a long text, signs of all kinds
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, None), (3, ""), (4, " \n\t "), (5, "a"), (5, "a"), (None, "b c d e f g"), (None, None),
    (6, "One TWO three four five six seven eight nine ten eleven twelve"),
    (7, "x" * 3000), (8, " ".join(f"w{i % 997}é" for i in range(20000))),
    (9, "日本語 текст ñandú 🎉 \x00 \x85   * # |"), (10, "\n".join(["same line here"] * 40)),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
