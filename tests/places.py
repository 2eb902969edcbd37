"""Where test data lies; a module of its own, since several folders have a conftest."""

TESTDATA = "/root/testdata"
