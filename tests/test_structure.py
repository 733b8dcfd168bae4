from codesift.functions.structure import measure, with_structure


def test_measure():
    assert measure("")[0] == 1 and measure("")[1] is None
    assert measure("strcpy(dest, src);")[0] == 5
    assert measure("int main() {") == (None, None)
    assert measure("a\x00b") == (None, None)
    assert measure("(" * 5000) == (None, None)
    assert measure("def f(x):\n    if x and y:\n        return 1\n")[1] == 3
    assert measure("def f(x):\n    for i in x:\n        pass\n    else:\n        pass\n")[1] == 3
    two = "def f():\n    pass\nclass C:\n    def a(self):\n        pass\n    def b(self):\n        while 1:\n            pass\n"
    # f 1; class (1 + 2) // 2 + 1 = 2; a 1; b 2
    assert measure(two)[1] == 6 / 4


def test_fallbacks(spark):
    rows = [("if (x) { while (y) { } }",), ("",), (None,), ("x = 1",)]
    df = spark.createDataFrame(rows, "code string")
    got = [(r["ast_depth"], r["complexity"]) for r in with_structure(df).collect()]
    assert got == [(2, 1.0), (1, 1.0), (1, 1.0), (4, 1.0)]


def test_blocks_inside_statements_and_scopes():
    code = (
        "try:\n    def f(x):\n        if x:\n            pass\nexcept E:\n    pass\n"
        "if a:\n    class C:\n        def m(self):\n            return lambda y: y if y else 0\n")
    # f counts 2, the class 1 + 1, its method 1: what the lambda decides is not the method's.
    assert measure(code)[1] == (2 + 2 + 1) / 3


def test_nested_functions_are_not_their_outer_ones():
    assert measure("def f():\n    def g(x):\n        if x:\n            pass\n    return g\n")[1] == 1.0
