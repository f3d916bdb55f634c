def tuples(df, *columns):
    """Rows as a list of plain tuples, in the order Spark gives them."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def bag(df, *columns):
    """Rows in an order of their own, nulls included."""
    return sorted(tuples(df, *columns), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
