"""Where step tables come from and go to."""
