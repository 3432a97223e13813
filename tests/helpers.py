"""What several tests share."""

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    """The physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_after(df):
    """The final adaptive plan, after running the query."""
    df.collect()
    return plan_of(df).split("+- == Initial Plan ==")[0]
