"""Where the tests find the driver's fixture tables."""

SF001 = "/root/testdata/sf0.01"
