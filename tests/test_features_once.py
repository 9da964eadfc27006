"""Code reports write the features of their examples, not the text that would be read again for each pass."""

import pytest

from corpusops.plans import evaluation, training

SF = "/root/testdata/sf0.001"


class Written(Exception):
    pass


def stop(df, *by):
    raise Written(df.columns)


@pytest.mark.parametrize("plans, query", [(training, "bayes_code_report"), (evaluation, "code_classifier_report"), (evaluation, "fresh_code_report")])
def test_examples_leave_features_only(spark, monkeypatch, plans, query):
    monkeypatch.setattr(plans, "durable", stop)
    with pytest.raises(Written) as first:
        getattr(plans, query)(spark, SF)
    assert "counts" in first.value.args[0] and "code" not in first.value.args[0]
