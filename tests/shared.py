"""What several test modules use."""

SMALL = "/root/testdata/sf0.001"
