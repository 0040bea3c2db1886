from weeklens.llm import quality


def test_shape_comes_from_the_whole_word():
    start = "a1B2" * 10
    assert quality.units(start + "/+=")[1] != quality.units(start)[1]
    assert quality.units("x" * 50 + "-1")[1] == quality.units("x-1")[1] == "#a-0"
    assert len(quality.units("Ab1/x+" * 100_000)[1]) < 10
