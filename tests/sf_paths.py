"""Folders of the given tables, for every test (a name that no other test folder defines)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
