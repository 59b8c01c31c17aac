"""Mass flows along chains of any length."""

import pytest

from lakeload.llm import link_trust


def test_mass_reaches_the_end_of_a_long_chain(llm):
    hosts = [f"h{i:02}" for i in range(31)]
    start = llm.createDataFrame([(h, float(h == "h00")) for h in hosts], "host string, seed double")
    edges = llm.createDataFrame([(a, b, 1) for a, b in zip(hosts[:-1], hosts[1:], strict=True)], "src string, dst string, links long")
    got = {r.host: r.seed for r in link_trust.flowed(start, edges, "src", "dst", ["seed"]).collect()}
    want = {h: (1 - link_trust.DAMPING) * link_trust.DAMPING**i for i, h in enumerate(hosts)}
    want["h30"] = link_trust.DAMPING**30  # a host without links keeps its mass
    assert got == pytest.approx(want, abs=1e-5)
