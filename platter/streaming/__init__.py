"""No operator of this library is a stream: new data arrives as dated snapshots, and finished work is skipped by anti-joins."""
