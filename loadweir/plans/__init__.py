"""Plans that put operators together into loads."""
