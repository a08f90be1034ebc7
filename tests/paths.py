"""Places that several test modules name."""

SF_SMALL = "/root/testdata/sf0.001"
