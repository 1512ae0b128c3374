"""What several tests share."""

SF = "/root/testdata/sf0.001"


def rows_of(pdf):
    """Rows as sorted tuples of text, numbers to nine digits."""
    import numpy as np
    import pandas as pd

    def text(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
            return ""
        if isinstance(x, (bool, np.bool_)):
            return str(bool(x))
        if isinstance(x, (int, float, np.integer, np.floating)):
            return "%.9g" % float(x)
        return str(list(x)) if isinstance(x, (list, np.ndarray)) else str(x)

    cols = sorted(pdf.columns)
    return cols, sorted(tuple(text(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))
