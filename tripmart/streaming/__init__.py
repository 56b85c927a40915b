"""Jobs that go on from where their last run stopped."""
