"""DataFrame-to-DataFrame operators; none runs an action unless its text says so."""
