"""Named query plans over the bound test data and their SQL oracles."""
