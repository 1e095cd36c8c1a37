"""Swings are dealt by official once."""

import re

from ledgerline.operators import profiles
from ledgerline.plans.analog import Analog, Laid

SF = "/root/testdata/sf0.001"


def test_swings_dealt_by_official_once(spark):
    plainly = profiles.swings(Analog(spark, SF).crew, Analog(spark, SF).logs, Analog(spark, SF).schedule, least=1)
    t = Laid(spark, SF)
    dealt = profiles.swings(t.crew, t.logs, t.schedule, least=1, send_means=True, tasks=t.tasks)
    assert dealt.count() == plainly.count() > 0 and dealt.exceptAll(plainly).isEmpty()
    told = dealt._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(ref_key", told)) == 1
