"""Account tables derived from the sample data, as ``FIXTURES.md`` describes them."""
