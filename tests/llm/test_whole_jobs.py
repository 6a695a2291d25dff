"""Results hold for whole inputs, also where short cuts would do on prose."""

from gristmill.llm import mpeg_audio as mp


def test_payload_like_a_tag():
    """op4: "TAG" may stand in the payload where an ID3v1 tag would begin; a tag behind the last frame is still one."""
    like_a_tag = 0
    for n in range(1, 3000, 7):
        for shift in ("", "x", "xx"):
            text = shift + "TAG" * n
            payload = mp.padded(text)
            stream = mp.write_stream(payload, len(text))
            like_a_tag += stream[-128:-125] == b"TAG"
            for data in (stream, stream + b"TAG" + b"\0" * 125):
                got = mp.read_stream(data)
                assert got["payload"] == payload and got["skipped"] == got["crc_bad"] == 0
    assert like_a_tag > 50
