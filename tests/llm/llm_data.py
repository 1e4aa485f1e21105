"""Texts for the tests of this folder."""

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(40)}" for _ in range(n))


ODD = [(None, None), (None, "alone without id"), (1, ""), (2, "   \n\t "), (3, "one"), (3, "one"), (4, "Two words."), (5, "x" * 30_000)]


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text), with an extra column whose name clashes with an added one."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, IDS string"
        return spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], schema)

    return make
