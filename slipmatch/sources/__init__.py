"""Where the eleven tables come from."""
