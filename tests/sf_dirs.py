"""Folders of the test tables, under a name that no other test folder uses."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"
