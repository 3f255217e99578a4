from mortar.operators.arrays import expand_array, fill_and_size, pad_array


def test_fill_pad_expand(spark):
    df = spark.createDataFrame([("a", [3]), ("b", None), ("c", list(range(14)))],
                               "LOAN_ID string, L array<int>")
    filled = {r.LOAN_ID: (r.L, r.L_OrigSize) for r in fill_and_size(df, "L").collect()}
    assert filled["b"] == ([], 0) and filled["a"] == ([3], 1) and filled["c"][1] == 14
    padded = {r.LOAN_ID: r.L for r in pad_array(df, "L", 12).collect()}
    assert padded["a"] == [-1] * 11 + [3]
    assert padded["b"] == [-1] * 12
    assert padded["c"] == list(range(14))  # longer arrays unchanged
    wide = {r.LOAN_ID: r for r in expand_array(df, "L", 4).collect()}
    assert [wide["a"][f"L_{i}"] for i in range(4)] == [-1, -1, -1, 3]
    assert "L_4" not in wide["a"].asDict()  # the size argument is honoured
    assert wide["a"].L_OrigSize == 1 and wide["b"].L_OrigSize == 0
