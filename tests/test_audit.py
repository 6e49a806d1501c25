from quire.operators import audit, export
from quire.plans.registry import Run


def test_model_names_are_values(spark, sf):
    """A name with quotes is compared as it is: here it's no gold's, so no gold is current and all of it is another's."""
    r = Run(spark, sf)
    row = audit.summed(r.audited(export.page_examples(r.gold)), "a'b\\c").first()
    assert (row.gold, row.accepted) == (0, 0) and row.other_gold > 0
    row = audit.summed(r.audited(export.page_examples(r.gold)), "m").first()
    assert row.other_gold == 0 and row.gold == row.accepted > 0
