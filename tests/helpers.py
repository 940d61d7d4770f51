import contextlib
import io
import math


def plan_of(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def same_rows(a, b, digits=9):
    """Both frames hold the same rows; doubles agree to `digits` places."""
    def lines(df):
        cols = sorted(df.columns)

        def plain(x):
            if isinstance(x, float):
                return "nan" if math.isnan(x) else f"{x:.{digits}f}".replace("-0." + "0" * digits, "0." + "0" * digits)
            if isinstance(x, list):
                return str([plain(v) for v in x])
            return str(x)
        return sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    left, right = lines(a), lines(b)
    assert len(left) == len(right)
    assert left == right


def by_key(df, key="reading_id"):
    return {r[key]: r.asDict() for r in df.collect()}
